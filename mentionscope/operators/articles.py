"""Article-line parsing and name extraction.

Three reading rules exist for the same lines and are exposed as presets:

* ``rdd``    - lenient: TAB split with trailing empties dropped, keep lines
  that reach the names column, day from the first eight stamp digits, empty
  names kept, the exact stop-name ``Type ParentCategory`` removed;
* ``ds``     - strict: exactly 27 fields, a parsable 14-digit stamp, an
  integer (or empty) source type, no field opening a CSV quote, a non-empty
  names field; names containing ``Category`` removed;
* ``stream`` - lenient, empty names removed, no stop-names, the stamp is
  not parsed (a line with a bad stamp still counts; its day is NULL).

Every step is a narrow built-in expression: the whole parse runs inside one
codegen stage next to the scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.names import (
    NAME_DELIM, STOP_CONTAINS_DEFAULT, STOP_EXACT_DEFAULT, day_from_stamp, drop_empty,
    has_names_field, parse_stamp, record_key, split_names, tab_fields, tab_fields_all,
)
from ..schema import ARTICLE_SCHEMA, N_FIELDS, NAMES_INDEX, STAMP_INDEX


@dataclass(frozen=True)
class ReadRules:
    validity: str = "lenient"           # "lenient" | "strict"
    keep_empty: bool = True             # keep "" names (RDD) or drop them (stream)
    stop_exact: tuple = ()              # names removed exactly
    stop_contains: tuple = ()           # names removed when containing any of these
    delim: str = NAME_DELIM             # name-list delimiter pattern
    needs_day: bool = True              # reject lines whose day does not parse


# ---- fixed values: the three reading rules ---------------------------------
RULES = {
    "rdd": ReadRules("lenient", True, tuple(STOP_EXACT_DEFAULT), ()),
    "ds": ReadRules("strict", True, (), tuple(STOP_CONTAINS_DEFAULT)),
    "stream": ReadRules("lenient", False, (), (), needs_day=False),
}
# -----------------------------------------------------------------------------


def rules_for(mode: str | ReadRules) -> ReadRules:
    return mode if isinstance(mode, ReadRules) else RULES[mode]


# A quoted text to the end of its field (spaces behind it fall away), and a quote that nothing closes within it;
# a backslash escapes. Any other quote is plain text.
_QUOTED = r'^"[^"\\]*+(?:\\.[^"\\]*+)*+" *\z'
_OPEN = r'^"[^"\\]*+(?:\\.[^"\\]*+)*+\\?\z'


def csv_value(x) -> "F.Column":
    """A field as the CSV reader returns it: the quotes of a field that is one
    quoted text removed and escaped quotes undone, empty -> NULL."""
    text = F.when(x.startswith('"') & x.rlike(_QUOTED), F.replace(F.substring(x, F.lit(2), F.length(F.rtrim(x)) - 2), F.lit('\\"'), F.lit('"'))).otherwise(x)
    return F.when(text != "", text)


def strict_valid(fields_all) -> "F.Column":
    """Row passes the typed 27-field reading (CSV with DROPMALFORMED).

    A field that opens a quote without closing it swallows the TABs after it
    in the CSV reader, so the row is malformed.
    """
    stamp = csv_value(F.get(fields_all, STAMP_INDEX))
    stype = csv_value(F.get(fields_all, 2))
    return ((F.size(fields_all) == N_FIELDS)
            & (stamp.isNull() | parse_stamp(stamp).isNotNull())
            & (stype.isNull() | stype.try_cast("int").isNotNull())
            & ~F.exists(fields_all, lambda x: x.startswith('"') & x.rlike(_OPEN)))


def parse_articles(lines: DataFrame, mode: str | ReadRules = "rdd", value: str = "value",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Split lines and keep what the chosen rule keeps.

    Returns ``*keep, key, n_fields, day, allnames, valid`` for every input
    line; ``valid`` is false for lines the rule rejects (use :func:`accepted`
    / :func:`rejects`). ``n_fields`` counts fields as the rule sees them.
    """
    r = rules_for(mode)
    v = F.col(value)
    # The split is computed once into a column; every field below reads it.
    split = tab_fields_all(v) if r.validity == "strict" else tab_fields(v)
    base = lines.select(*keep, v.alias("__v"), split.alias("__f"))
    f = F.col("__f")
    if r.validity == "strict":
        ts = parse_stamp(csv_value(F.get(f, STAMP_INDEX)))
        names = csv_value(F.get(f, NAMES_INDEX))     # CSV: empty -> NULL, quotes removed
        day = ts.cast("date")
        valid = strict_valid(f) & ts.isNotNull() & names.isNotNull()
    else:
        day = day_from_stamp(F.get(f, STAMP_INDEX))
        names = F.get(f, NAMES_INDEX)
        valid = has_names_field(f) & (day.isNotNull() if r.needs_day else F.lit(True))
    return base.select(*keep, record_key(F.col("__v")).alias("key"), F.size(f).alias("n_fields"),
                       day.alias("day"), names.alias("allnames"), valid.alias("valid"))


def keep_rows(df: DataFrame, kept) -> DataFrame:
    """The rows where ``kept`` holds, by an explode of one or no element: a filter would be
    pushed below the parse, into the scan or a join, and evaluate the whole parse there again."""
    return df.select("*", F.explode(F.when(kept, F.array(F.lit(True)))).alias("__kept")).drop("__kept")


def accepted(parsed: DataFrame) -> DataFrame:
    return keep_rows(parsed, F.col("valid")).drop("valid")


def rejects(parsed: DataFrame) -> DataFrame:
    """Lines the rule dropped (the reject count is ``rejects(p).count()``)."""
    return parsed.where(~F.col("valid")).drop("valid")


def explode_names(parsed: DataFrame, mode: str | ReadRules = "rdd",
                  keep: tuple[str, ...] = ("day",)) -> DataFrame:
    """One row per mention ``(*keep, name)``; stop-names go first.

    Stop-name filters are applied before any aggregate, so they cut shuffle
    volume instead of being applied to the final lists.
    """
    r = rules_for(mode)
    arr = split_names(F.col("allnames"), r.delim)
    if not r.keep_empty:
        arr = drop_empty(arr)
    # Rejected lines explode a NULL array (no rows): no separate filter, so the
    # parse is not re-evaluated below it.
    out = parsed.select(*keep, F.explode(F.when(F.col("valid"), arr)).alias("name"))
    if r.stop_exact:
        out = out.where(~F.col("name").isin(list(r.stop_exact)))
    for s in r.stop_contains:
        out = out.where(~F.col("name").contains(s))
    return out


def mentions(lines: DataFrame, mode: str | ReadRules = "rdd", value: str = "value",
             keep: tuple[str, ...] = ("day",)) -> DataFrame:
    """Lines -> ``(*keep, name)`` mentions under one reading rule.

    ``keep`` may name parse outputs (``key``, ``day``) or input columns.
    """
    passthrough = tuple(c for c in keep if c in lines.columns)
    return explode_names(parse_articles(lines, mode, value, passthrough), mode, keep)


def mentions_and_rejects(lines: DataFrame, mode: str | ReadRules = "rdd", value: str = "value",
                         keep: tuple[str, ...] = ()) -> DataFrame:
    """Mentions and rejected lines of one reading, in one pass -> ``*keep, kind, day, item``.

    ``kind`` is ``mention`` (``item``: the name) or ``reject`` (``item``: the whole line, no day).
    """
    r = rules_for(mode)
    parsed = parse_articles(lines, r, value, (*keep, value))
    arr = split_names(F.col("allnames"), r.delim)
    if not r.keep_empty:
        arr = drop_empty(arr)

    def kept(name):
        found = [name.isin(list(r.stop_exact))] if r.stop_exact else []
        return ~reduce(lambda a, b: a | b, found + [name.contains(s) for s in r.stop_contains], F.lit(False))

    if r.stop_exact or r.stop_contains:
        arr = F.filter(arr, kept)
    kind = F.when(F.col("valid"), "mention").otherwise("reject")
    return parsed.select(*keep, kind.alias("kind"), F.when(F.col("valid"), F.col("day")).alias("day"),
                         F.explode(F.when(F.col("valid"), arr).otherwise(F.array(F.col(value)))).alias("item"))


def drop_stop_names(m: DataFrame, stop: DataFrame, name: str = "name") -> DataFrame:
    """P10: remove a list of known false positives with an anti-join.

    The write-up's list has ten entries; whether a list is broadcast is left to
    the planner, which measures it.
    """
    s = stop.select(F.col(stop.columns[0]).alias(name)).distinct()
    return m.join(s, on=name, how="left_anti")


def typed_articles(lines: DataFrame, value: str = "value", mode: str = "drop",
                   observation: Observation | None = None) -> DataFrame:
    """Bind each line to the 27-column typed record (strict reading).

    Empty fields become NULL, the stamp a timestamp, the source type an int. A line that the
    strict rule rejects is dropped (``mode="drop"``) or ends the job with an error that shows
    it (``"fail"``), in the same pass. ``observation`` receives the counts ``accepted`` and
    ``rejected`` of that pass when the job has run.
    """
    if mode not in ("drop", "fail"):
        raise ValueError(f"mode must be 'drop' or 'fail', not {mode!r}")
    split = lines.select(F.col(value).alias("__line"), tab_fields_all(F.col(value)).alias("__f"))
    split = split.withColumn("__ok", F.coalesce(strict_valid(F.col("__f")), F.lit(False)))
    if observation is not None:
        split = split.observe(observation, F.count(F.when(F.col("__ok"), 1)).alias("accepted"),
                              F.count(F.when(~F.col("__ok"), 1)).alias("rejected"))
    fa = F.col("__f")
    cols = []
    for i, f in enumerate(ARTICLE_SCHEMA.fields):
        raw = csv_value(F.get(fa, i))
        if f.name == "timestamp":
            c = parse_stamp(raw)
        elif f.name == "sourcetype":
            c = raw.try_cast("int")
        else:
            c = raw
        cols.append(c.alias(f.name))
    if mode == "fail":
        shown = F.concat(F.lit("malformed article line: "), F.coalesce(F.substring("__line", 1, 200), F.lit("NULL")))
        kept = F.when(F.col("__ok"), F.lit(True)).otherwise(F.raise_error(shown).cast("boolean"))
    else:
        kept = F.col("__ok")
    return keep_rows(split, kept).select(*cols)
