"""Fixed values of the workflows this library re-expresses.

These defaults must equal the source workflows' values for results to line
up; they are stated here once, in natural order.  (Tokenizer values live
with the quantiser in ``tidecast.functions.tokens``; request formats with the
scorer in ``tidecast.streaming.scoring``.)
"""

# --- fixed values: data preparation
DAILY_KEEP = 1020                 # last points kept per daily series
DAILY_START = "2020-01-01"        # daily series are re-dated from this day
MONTHLY_KEEP = 60                 # first points kept per monthly series
MONTHLY_START = "2018-01-01"      # monthly series are re-dated to month ends from this month
SYNTH_START, SYNTH_END = "2021-01-01", "2023-12-31"   # random daily series span
RECORD_DEFAULT_START = "2000-01-01 00:00:00"          # training record start when a series has none

# --- fixed values: forecasting and serving
HORIZON = 10                      # prediction length of batch scoring and of {"inputs": ...} requests
SPLIT_REQUEST_HORIZON = 12        # default h of a dataframe_split request
NUM_SAMPLES = 10                  # sample paths per series, reduced to the median
BATCH_SIZE = 4                    # contexts per model call inside a task
CONTEXT_LENGTH = 512              # longest context handed to a model
MIN_FIT_LENGTH = 300              # shortest series a per-series fit accepts

# --- fixed values: training tables
MIN_PAST = 60                     # fewest past points before a training cut
MAX_MISSING_PROP = 0.9            # largest missing share of a usable series
DROP_PROB = 0.2                   # upper bound of the per-series drop probability
MASK_RATIO = (0.15, 0.5)          # share of trailing patches used as targets
MIN_PATCHES = 2                   # fewest patches in a masked window
PATCH_SIZES = (8, 16, 32, 64, 128)
PACK_LENGTH = 512                 # slots per packed training sequence

# --- fixed values: model selection
EARLY_STOP_PATIENCE = 3
EARLY_STOP_MIN_DELTA = 0.0
DEFAULT_VERSION = 1               # latest version reported for a name without versions
