"""The access-log table: columns, line pattern, fixed lists, metric names."""

from pyspark.sql import types as T

# The 26 columns of an access-log line, in line order.
ACCESS_LOG_COLUMNS = [
    ("bucketowner", "string"),
    ("bucket_name", "string"),
    ("requestdatetime", "string"),
    ("remoteip", "string"),
    ("requester", "string"),
    ("requestid", "string"),
    ("operation", "string"),
    ("key", "string"),
    ("request_uri", "string"),
    ("httpstatus", "string"),
    ("errorcode", "string"),
    ("bytessent", "bigint"),
    ("objectsize", "bigint"),
    ("totaltime", "string"),
    ("turnaroundtime", "string"),
    ("referrer", "string"),
    ("useragent", "string"),
    ("versionid", "string"),
    ("hostid", "string"),
    ("sigv", "string"),
    ("ciphersuite", "string"),
    ("authtype", "string"),
    ("endpoint", "string"),
    ("tlsversion", "string"),
    ("accesspointarn", "string"),
    ("aclrequired", "string"),
]

# The day directory a line came from, as text in this layout.
PARTITION_COLUMN = "timestamp"
DAY_FORMAT = "yyyy/MM/dd"
REQUEST_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"

# Columns 19-26 were added to the log format later; older lines stop after 18.
OPTIONAL_TAIL_START = 18

# Columns of the default projection that come straight from the log.
USAGE_COLUMNS = [
    "requestid",
    "operation",
    "key",
    "referrer",
    "bytessent",
    "objectsize",
    "httpstatus",
    "requestdatetime",
    "timestamp",
    "remoteip",
]
# Names of the first four path parts of the key.
KEY_PART_COLUMNS = ["dir", "folder", "category", "geom_type"]

# Fixed values of the request rules.
NO_VALUE = "-"
NO_KEY = "-"
NON_INTERACTION_METHODS = ["POST", "PUT", "DELETE"]
DOWNLOAD_METHOD = "GET"
UPLOAD_METHODS = ["PUT", "POST"]
META_KEY_PATTERN = "meta.json"
NO_REFERRER = "Direct or N/A"
NO_COUNTRY = "N/A"
NO_KEY_PART = "NA"
OTHER_FORMAT = "Other"

# Folders without project / feature / format rankings, and
# folders without a report section.
FOLDERS_WITHOUT_COMPONENTS = ["default", "athena", "FAVICON.ICO", "TEST-OBJECT"]
FOLDERS_WITHOUT_SECTION = ["athena", "TEST-OBJECT"]
LOG_FOLDER_PREFIX = "log"

# Length of the rankings.
TOP_FILES = 10
TOP_OTHERS = 5

# Keys of a report section's metrics (spelling included).
REPORT_METRICS = {
    "interactions_count": "total_overall_interactions_count",
    "downloads_count": "total_files_downloads_count",
    "unique_downloads": "total_unique_files_downloaded",
    "uploads_count": "total_dataset_uploaded_count",
    "download_size": "total_dataset_downloaded_size",
    "upload_size": "total_dataset_uploaded_size",
    "unique_users": "unique_users_overall",
    "unique_users_by_download": "unique_users_by_download",
}
DOWNLOAD_RANKINGS = {
    "file": "popular_files_by_download",
    "location": "top_user_locations_by_dowload",
    "referrer": "top_referrers_by_download",
    "project": "popular_projects_by_download",
    "feature": "popular_features_by_download",
    "fileformat": "popular_fileformats_by_download",
}
INTERACTION_RANKINGS = {
    "file": "popular_files_by_interaction",
    "location": "popular_locations_by_interaction",
    "referrer": "top_referrers_by_interaction",
    "project": "popular_projects_by_interaction",
    "feature": "popular_features_by_interaction",
    "fileformat": "popular_fileformats_by_interaction",
}

# Keys of a day's metrics document.
DAILY_METRICS = [
    "interactions_count",
    "downloads_count",
    "unique_downloads",
    "uploads_count",
    "download_size",
    "upload_size",
    "unique_users",
]


def access_log_schema() -> T.StructType:
    fields = [T.StructField(n, T.StringType() if t == "string" else T.LongType()) for n, t in ACCESS_LOG_COLUMNS]
    return T.StructType([*fields, T.StructField(PARTITION_COLUMN, T.StringType())])
