"""Metrics of the whole service and of every folder from one pass over the requests.

Requests are counted per distinct key, address and referrer (one shuffle), then
each of those rows adds to the metrics it bears on, as (metric, sub_key, n)
entries that are summed up (a second shuffle, of what the counting left over).

Jobs write the counts to the shared folder in between. They can then be read twice:
entries that only one row can make, such as the downloads of a file, are final as they
are, and the second shuffle carries the others only, summed per task first.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bucketlens.operators.geo import GeoTable, resolve_addresses
from bucketlens.operators.metrics import ADDRESS, KEY, REFERRER, count_values, in_set, set_columns
from bucketlens.session import staged

FOLDER = "top_level_key"
WHOLE_SCOPE, FOLDER_SCOPE = "whole", "folder"


# The plain metrics as sums over rows of counts, by the kind of row they come from.
KEY_SUMS = {
    "interactions_count": "interactions",
    "downloads_count": "downloads",
    "unique_downloads": f"IF({KEY} IS NOT NULL AND downloads > 0, 1, 0)",
    "uploads_count": f"IF({KEY} IS NOT NULL AND uploads > 0, 1, 0)",
    "download_size": "download_bytes",
    "upload_size": "upload_bytes",
}
ADDRESS_SUMS = {
    "unique_users": f"IF({ADDRESS} IS NOT NULL, 1, 0)",
    "unique_users_by_download": f"IF({ADDRESS} IS NOT NULL AND downloads > 0, 1, 0)",
}
SUMS = [*KEY_SUMS, *ADDRESS_SUMS]


@dataclass(frozen=True)
class Value:
    """A value counted under a metric: ``sub_key`` gets ``n``, where ``when`` holds.

    All three are SQL expressions over a row of counts.
    """

    metric: str
    sub_key: str
    n: str
    when: str = "true"


def _struct(scope: str, metric: str | None = None, sub_key: str = "NULL", n: str = "NULL", sums: dict[str, str] = {}) -> str:
    name = f"'{metric}'" if metric else "CAST(NULL AS STRING)"
    totals = "".join(f", '{m}', CAST({sums.get(m, 'NULL')} AS BIGINT)" for m in SUMS)
    return (
        f"named_struct('scope', '{scope}', 'metric', {name}, 'sub_key', CAST({sub_key} AS STRING), "
        f"'n', CAST({n} AS BIGINT){totals})"
    )


def _final_struct(scope: str, value: Value) -> str:
    return (
        f"named_struct('scope', '{scope}', 'metric', '{value.metric}', 'sub_key', CAST({value.sub_key} AS STRING), "
        f"'n', CAST(IF({value.when}, {value.n}, NULL) AS BIGINT))"
    )


def grouping_sets(outer: list[str]) -> list[list[str]]:
    """Per key and referrer by folder (a key has one folder); addresses also overall."""
    return [[*outer, FOLDER, KEY], [*outer, FOLDER, ADDRESS], [*outer, ADDRESS], [*outer, FOLDER, REFERRER]]


def count_for_sections(prepared: DataFrame, outer: list[str]) -> DataFrame:
    return count_values(prepared, grouping_sets(outer))


def locate_counts(counted: DataFrame, geo: GeoTable, outer: list[str]) -> DataFrame:
    """Counts with the country of those per address, and ``kind`` naming the grouping set."""
    kinds = ("key", "folder_address", "address", "referrer")
    columns = set_columns(grouping_sets(outer))
    located = resolve_addresses(counted, geo, [*columns, "grouping"], F.col(ADDRESS))
    kind = F.lit(None)
    for name, grouping_set in zip(kinds, grouping_sets(outer)):
        kind = F.when(in_set(columns, grouping_set), name).otherwise(kind)
    return located.withColumn("kind", kind)


def sum_sections(
    located: DataFrame, outer: list[str], metrics: list[str], whole: dict[str, list[Value]], folder: dict[str, list[Value]],
    written: bool = False,
) -> DataFrame:
    """Add counted rows up to the metrics of every section.

    Each row gives one entry with its plain metrics per level, and one per value
    that ``whole`` and ``folder`` list for its kind (key, remoteip, referrer). Result:
    the ``outer`` columns, ``scope``, the folder (NULL for the whole service),
    ``metric``, ``sub_key`` (NULL for plain metrics) and ``n``. With ``written`` the
    counts are written first and final entries stay out of the second shuffle.
    """

    counts = staged(located, "section-counts") if written else located

    def final(scope: str, column: str, value: Value) -> bool:
        """Does only one counted row bear on each sub_key of the value?"""
        return written and value.sub_key == column and (column == KEY or column == REFERRER and scope == FOLDER_SCOPE)

    def values(column: str, *scopes: str) -> list[tuple[str, Value, bool]]:
        given = {WHOLE_SCOPE: whole, FOLDER_SCOPE: folder}
        return [(scope, v, final(scope, column, v)) for scope in scopes for v in given[scope][column]]

    kinds = [
        ("key", KEY, KEY_SUMS, [WHOLE_SCOPE, FOLDER_SCOPE]),
        ("folder_address", ADDRESS, ADDRESS_SUMS, [FOLDER_SCOPE]),
        ("address", ADDRESS, ADDRESS_SUMS, [WHOLE_SCOPE]),
        ("referrer", REFERRER, {}, [WHOLE_SCOPE, FOLDER_SCOPE]),
    ]
    summed_cases, final_cases = [], []
    for kind, column, sums, scopes in kinds:
        listed = values(column, *scopes)
        structs = [_struct(scope, sums=sums) for scope in scopes if sums]
        structs += [_struct(scope, v.metric, v.sub_key, f"IF({v.when}, {v.n}, NULL)") for scope, v, is_final in listed if not is_final]
        finals = [_final_struct(scope, v) for scope, v, is_final in listed if is_final]
        for cases, found in ((summed_cases, structs), (final_cases, finals)):
            if found:
                cases.append(f"WHEN '{kind}' THEN array({', '.join(found)})")

    section = F.expr(f"IF(scope = '{FOLDER_SCOPE}', {FOLDER}, NULL)").alias(FOLDER)

    def entries(cases: list[str]) -> DataFrame:
        exploded = counts.select(*outer, FOLDER, F.expr(f"inline(CASE kind {' '.join(cases)} END)"))
        # A value counts from its first request on.
        return exploded.where("metric IS NULL OR (n > 0 AND sub_key IS NOT NULL)")

    summed = entries(summed_cases).groupBy(*outer, "scope", section, "metric", "sub_key").agg(*(F.sum(c).alias(c) for c in ["n", *SUMS]))
    plain = ", ".join(f"named_struct('metric', '{m}', 'sub_key', CAST(NULL AS STRING), 'n', {m})" for m in metrics)
    as_rows = f"IF(metric IS NULL, array({plain}), array(named_struct('metric', metric, 'sub_key', sub_key, 'n', n)))"
    rows = summed.select(*outer, "scope", FOLDER, F.expr(f"inline({as_rows})"))
    if not final_cases:
        return rows
    return rows.unionByName(entries(final_cases).select(*outer, "scope", section, "metric", "sub_key", "n"))
