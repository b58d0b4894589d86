"""Expressions over one request: time, sizes, method, path parts, referrer, class."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from bucketlens import schema as S

# Where the network location sits in a URL, after the outer quotes are gone:
# optional blanks and scheme, then everything between // and the path.
NETWORK_LOCATION = r"^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"


def request_time(text: Column, lenient: bool = False) -> Column:
    """Zoned request time; text that is no time fails the job unless ``lenient``."""
    if lenient:
        return F.try_to_timestamp(text, F.lit(S.REQUEST_TIME_FORMAT))
    return F.to_timestamp(text, S.REQUEST_TIME_FORMAT)


def byte_count(size: Column) -> Column:
    """Bytes as BIGINT; missing or not numeric counts as 0."""
    return F.coalesce(size.try_cast("bigint"), F.lit(0).cast("bigint"))


def method(operation: Column) -> Column:
    """Second dot part of the operation, or all of it when there is no dot."""
    return F.substring_index(F.substring_index(operation, ".", 2), ".", -1)


def key_part(key: Column, index: int) -> Column:
    """Path part ``index`` (from 0) of the key; NULL beyond the last one."""
    return F.get(F.split(key, "/", -1), F.lit(index))


def top_level_key(key: Column) -> Column:
    return F.substring_index(key, "/", 1)


def project(key: Column) -> Column:
    return F.coalesce(key_part(key, 1), F.lit(S.NO_KEY_PART))


def feature(key: Column) -> Column:
    return F.coalesce(key_part(key, 2), F.lit(S.NO_KEY_PART))


def file_format(key: Column) -> Column:
    """Text between the last ``_`` and the next dot; a path there means ``Other``."""
    tail = F.substring_index(F.substring_index(key, "_", -1), ".", 1)
    return (
        F.when(F.contains(tail, F.lit("/")), S.OTHER_FORMAT)
        .when(F.contains(key, F.lit("_")), tail)
        .otherwise(F.when(key.isNotNull(), S.NO_KEY_PART))
    )


def referrer_host(referrer: Column) -> Column:
    """Network location of the referring URL, user info and port included."""
    trimmed = F.btrim(referrer, F.lit('"'))
    # URL parsing drops these characters; they are rare and dropping them is slow.
    broken = F.contains(trimmed, F.lit("\t")) | F.contains(trimmed, F.lit("\r")) | F.contains(trimmed, F.lit("\n"))
    url = F.when(broken, F.translate(trimmed, "\t\r\n", "")).otherwise(trimmed)
    host = F.regexp_extract(url, NETWORK_LOCATION, 1)
    return F.when(F.length(host) > 0, host).otherwise(S.NO_REFERRER)


def partition_day(day_text: Column) -> Column:
    return F.to_date(day_text, S.DAY_FORMAT)


def is_interaction(method_name: Column) -> Column:
    """Anything but POST, PUT and DELETE; a missing method counts as interaction."""
    return ~F.coalesce(method_name, F.lit("")).isin(S.NON_INTERACTION_METHODS)


def is_download(method_name: Column) -> Column:
    return method_name.eqNullSafe(F.lit(S.DOWNLOAD_METHOD))


def is_upload(method_name: Column) -> Column:
    return F.coalesce(method_name, F.lit("")).isin(S.UPLOAD_METHODS)


def is_object_request(key: Column) -> Column:
    return key != S.NO_KEY


def is_meta_file(key: Column) -> Column:
    return key.rlike(S.META_KEY_PATTERN)


def has_components(folder: Column) -> Column:
    """Whether projects, features and formats are ranked for this folder."""
    return ~folder.isin(S.FOLDERS_WITHOUT_COMPONENTS)


def has_section(folder: Column) -> Column:
    """Whether the report shows a section for this folder."""
    return ~(folder.startswith(S.LOG_FOLDER_PREFIX) | folder.isin(S.FOLDERS_WITHOUT_SECTION))
