"""Article record schema.

The news feed is a TAB separated line per article. Two naming sets exist for
its 27 columns: short field names used by the typed record and the feed's own
header names. Both are fixed values of the format and must stay exactly as
written here, in column order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: the 27 article columns, in order -----------------------
# (field name, header name, header type)
ARTICLE_COLUMNS = [
    ("identifier", "GKGRECORDID", "STRING"),
    ("timestamp", "DATE", "DATE"),
    ("sourcetype", "SourceCollectionIdentifier", "INTEGER"),
    ("source", "SourceCommonName", "STRING"),
    ("sourceIdentifier", "DocumentIdentifier", "STRING"),
    ("counts", "Counts", "STRING"),
    ("countsoffset", "V2Counts", "STRING"),
    ("themes", "Themes", "STRING"),
    ("enhancedthemes", "V2Themes", "STRING"),
    ("locations", "Locations", "STRING"),
    ("locations2", "V2Locations", "STRING"),
    ("persons", "Persons", "STRING"),
    ("persons2", "V2Persons", "STRING"),
    ("organizations", "Organizations", "STRING"),
    ("organizations2", "V2Organizations", "STRING"),
    ("tone2", "V2Tone", "STRING"),
    ("dates", "Dates", "STRING"),
    ("gcam", "GCAM", "STRING"),
    ("sharingimage", "SharingImage", "STRING"),
    ("relatedImages", "RelatedImages", "STRING"),
    ("socialimageembeds", "SocialImageEmbeds", "STRING"),
    ("socialvideoembeds", "SocialVideoEmbeds", "STRING"),
    ("quotations", "Quotations", "STRING"),
    ("allnames", "AllNames", "STRING"),
    ("amounts", "Amounts", "STRING"),
    ("translationinfo", "TranslationInfo", "STRING"),
    ("extras", "Extras", "STRING"),
]
# ---- end of fixed values ----------------------------------------------------

N_FIELDS = len(ARTICLE_COLUMNS)
FIELD_NAMES = [c[0] for c in ARTICLE_COLUMNS]
HEADER_TO_FIELD = {c[1]: c[0] for c in ARTICLE_COLUMNS}
FIELD_INDEX = {name: i for i, name in enumerate(FIELD_NAMES)}
NAMES_INDEX = FIELD_INDEX["allnames"]        # 23
STAMP_INDEX = FIELD_INDEX["timestamp"]       # 1

# The typed record: the timestamp is a real timestamp, the collection id an
# int, everything else text. All columns are nullable.
_TYPED = {"timestamp": T.TimestampType(), "sourcetype": T.IntegerType()}
ARTICLE_SCHEMA = T.StructType([
    T.StructField(name, _TYPED.get(name, T.StringType()), True) for name in FIELD_NAMES
])

_HEADER_TYPES = {
    "STRING": T.StringType(), "INTEGER": T.IntegerType(), "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(), "BIGINT": T.LongType(), "FLOAT": T.DoubleType(),
}


def schema_from_header_table(header: DataFrame, use_field_names: bool = True) -> T.StructType:
    """Turn a (name, type, nullability) table into a ``StructType``.

    The header table has at most a few dozen rows (one per column), so it is
    safe to bring it to the driver; this is schema metadata, not data.
    """
    rows = header.select(
        F.monotonically_increasing_id().alias("pos"), "name", "type", "nullability"
    ).orderBy("pos").collect()
    fields = []
    for r in rows:
        name = HEADER_TO_FIELD.get(r["name"], r["name"]) if use_field_names else r["name"]
        dtype = _HEADER_TYPES.get((r["type"] or "STRING").upper(), T.StringType())
        fields.append(T.StructField(name, dtype, (r["nullability"] or "").upper() != "REQUIRED"))
    return T.StructType(fields)


def read_header_table(spark, path: str) -> DataFrame:
    """Read a TAB separated header table (trailing TAB allowed) as text."""
    parts = F.split(F.col("value"), "\t")
    return (spark.read.text(path)
            .where(F.length(F.trim(F.col("value"))) > 0)
            .select(parts[0].alias("name"), parts[1].alias("type"), parts[2].alias("nullability")))
