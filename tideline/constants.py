"""Fixed values that must equal the behaviour being reproduced.

Everything below is a literal observed in the original pipeline's
configuration and scripts (topic names, field names, connector settings,
validation messages, the missing-value tokens of the CSV reader it relied
on).  They are stated once, here, in their natural order.
"""

# --- fixed values: topics and record fields -------------------------------
CAPTURE_TOPIC = "business_postgres.public.business_ncr_ride_bookings"
PRODUCER_TOPIC = "business-ncr-ride-bookings"
BUSINESS_TOPICS = (PRODUCER_TOPIC, CAPTURE_TOPIC)
TOPIC_PREFIX = "business_postgres"
TABLE_INCLUDE_LIST = "public.business_.*"
BOOKING_FIELD = "ncr_ride_bookings.csv/booking+value"
RIDE_FIELD = "ncr_ride_bookings.csv/ride+distance"
OP_FIELD = "__op"

# --- fixed values: change-capture settings ---------------------------------
DROP_TOMBSTONES = False          # tombstones travel on as null values
DELETE_HANDLING = "drop"         # delete events are removed by the unwrap step
SNAPSHOT_MODE = "never"          # no initial-snapshot ('r') events

# --- fixed values: byte-literal cleaning, applied in this order -------------
BYTE_LITERAL_PATTERNS = (r"^b'", r"'$", r'^"|"$')

# --- fixed values: streaming job --------------------------------------------
TRIGGER_INTERVAL = "10 seconds"
CHECKPOINT_SUBDIR = "_checkpoints"
STARTING_OFFSETS = "latest"
FAIL_ON_DATA_LOSS = "false"

# --- fixed values: message validation ---------------------------------------
REASON_EMPTY = "Empty message"
REASON_NOT_OBJECT = "Message is not a JSON object"
REASON_VALID = "Valid JSON message"
REASON_VALID_NO_TS = "Valid JSON message (no timestamp field)"
REASON_ERROR = "JSON validation error"
TIMESTAMP_KEYS = ("timestamp", "created_at", "op")
PREVIEW_CHARS = 200
TEST_ACTION = "test_message"

# --- fixed values: CSV loading and typing ------------------------------------
MISSING_TOKENS = (
    "", "NULL", "NA", "NaN", "nan", "null", "None", "N/A", "n/a", "<NA>",
    "#N/A", "#NA", "#N/A N/A", "-nan", "-NaN", "1.#IND", "-1.#IND",
    "1.#QNAN", "-1.#QNAN",
)
TRUE_TOKENS = ("True", "TRUE", "true")
FALSE_TOKENS = ("False", "FALSE", "false")
FILL_TOKEN = "NULL"
MISSING_TEXT_WIDTH = 3           # a missing value prints as 'nan'
VARCHAR_CAP = 1000
VARCHAR_DEFAULT = 255
FLOAT_SQL_TYPE = "DECIMAL(15,4)"
TABLE_PREFIX = "business_"
LOCAL_PREFIX = "local_"
KAGGLE_GLOB = "ncr_ride_bookings*.csv"
SOURCE_DOWNLOADED = "kaggle"     # report label of datasets fetched by name pattern
SOURCE_LOCAL = "local"           # report label of datasets given as local files
