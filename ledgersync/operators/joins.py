"""Join shapes of the extracts. Broadcasts are left to Spark's own size checks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgersync.functions.clock import ts

On = str | Sequence[str] | Sequence[tuple[str, str]]


def _pairs(on: On) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in on]


def lookup(base: DataFrame, dim: DataFrame, on: On, cols: dict[str, str], how: str = "left") -> DataFrame:
    """Join ``dim`` and keep ``cols`` of it (dimension column -> output name).

    Only the keys and the wanted columns of the dimension take part, so the scan
    is pruned and names never clash.
    """
    pairs = _pairs(on)
    keys = [f"__k_{i}" for i in range(len(pairs))]
    right = dim.selectExpr(
        *[f"`{r}` AS {k}" for k, (_, r) in zip(keys, pairs)], *[f"`{c}` AS `{n}`" for c, n in cols.items()]
    )
    cond = F.expr(" AND ".join(f"`{left}` = {k}" for k, (left, _) in zip(keys, pairs)))
    joined = base.join(right, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*keys)


def star_left(base: DataFrame, dims: Sequence[tuple[DataFrame, On, dict[str, str]]]) -> DataFrame:
    """A base table with several optional lookups."""
    for dim, on, cols in dims:
        base = lookup(base, dim, on, cols)
    return base


def nested_left(outer: DataFrame, inner: DataFrame, dim: DataFrame, on: On, inner_on: On, dim_cols: dict[str, str]) -> DataFrame:
    """``outer`` left-joined to (``inner`` left-joined to ``dim``) on columns of ``inner``."""
    subtree = lookup(inner, dim, inner_on, dim_cols)
    keys = {r for _, r in _pairs(on)}
    cols = {c: c for c in subtree.columns if c not in outer.columns and c not in keys}
    return lookup(outer, subtree, on, cols)


def self_lookup(df: DataFrame, fk: str, pk: str, cols: dict[str, str]) -> DataFrame:
    """Columns of the row of the same table that ``fk`` points to."""
    return lookup(df, df, [(fk, pk)], cols)


def code_lookup(
    df: DataFrame,
    codes: DataFrame,
    key: str,
    out: dict[str, str],
    domain: str | None = None,
    by: str = "oid",
    how: str = "left",
) -> DataFrame:
    """Translate ``key`` through one domain of the shared code table.

    ``by='oid'`` compares ids, ``by='data_value'`` the code text.
    """
    dim = codes if domain is None else codes.filter(F.col("table_key") == domain)
    if by == "data_value":
        df = df.withColumn("__code", F.col(key).cast("string"))
        return lookup(df, dim, [("__code", "data_value")], out, how).drop("__code")
    return lookup(df, dim, [(key, by)], out, how)


def require_match(df: DataFrame, right: DataFrame, on: On, cols: dict[str, str] | None = None) -> DataFrame:
    """Rows with a partner; without ``cols`` a semi join, so partners never multiply rows."""
    if cols:
        return lookup(df, right, on, cols, "inner")
    return lookup(df, right, on, {}, "left_semi")


def member_split(df: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is listed, rows whose key is not); a NULL key is in neither."""
    k = keys.select(F.col(keys.columns[0]).alias(key)).dropna()
    keyed = df.filter(F.col(key).isNotNull())
    return keyed.join(k, key, "left_semi"), keyed.join(k, key, "left_anti")


_LEVELS = 5  # day blocks of 1, 8, 64, 512 and 4096 days
_EDGE = 9  # code level of the partial first and last days
_ORIGIN = "DATE'0001-01-01'"
_day = f"CAST(datediff(to_date({{}}), {_ORIGIN}) AS BIGINT)".format


def _code(level: int, block: str) -> str:
    """One number for (level, block)."""
    return f"({level << 32}L + {block})"


def _run(level: int, lo: str, hi: str) -> str:
    """Codes of the blocks ``lo <= b < hi`` of a level, possibly none."""
    return f"IF({lo} < {hi}, sequence({_code(level, lo)}, {_code(level, hi)} - 1L), CAST(array() AS ARRAY<BIGINT>))"


def _with_blocks(df: DataFrame, lo: str, hi: str, out: str) -> DataFrame:
    """Add the codes of the few aligned day blocks that exactly cover ``lo <= day < hi``.

    Level by level, the days that do not fill a block of the next level stay where
    they are and the rest moves up.
    """
    df = df.withColumns({"__lo0": F.expr(lo), "__hi0": F.expr(hi)})
    parts, steps = [], ["__lo0", "__hi0"]
    for lv in range(_LEVELS):
        a, z = f"__lo{lv}", f"__hi{lv}"
        rest = _run(lv, a, z)
        if lv < _LEVELS - 1:
            up_a, up_z = f"__lo{lv + 1}", f"__hi{lv + 1}"
            df = df.withColumns({up_a: F.expr(f"shiftright({a} + 7, 3)"), up_z: F.expr(f"shiftright({z}, 3)")})
            steps += [up_a, up_z]
            split = f"concat({_run(lv, a, f'{up_a} * 8')}, {_run(lv, f'{up_z} * 8', z)})"
            rest = f"IF({up_a} < {up_z}, {split}, {rest})"
        moved_up = " AND ".join(f"__lo{i} < __hi{i}" for i in range(1, lv + 1)) or "TRUE"
        parts.append(f"IF({moved_up}, {rest}, CAST(array() AS ARRAY<BIGINT>))")
    return df.withColumn(out, F.expr(f"concat({', '.join(parts)})")).drop(*steps)


def _cut_spans(spans: DataFrame) -> DataFrame:
    """Add one row for each block code of a span (``__from``, ``__to``): its whole days as aligned blocks, and its partial
    first and last day on their own. The codes of a span don't overlap, so a point of it meets exactly one of them."""
    sp = spans.filter(F.col("__from") <= F.col("__to")).withColumns(
        {
            "__first": F.expr(_day("__from")),
            "__last": F.expr(_day("__to")),
            "__midnight": F.expr("__from = CAST(to_date(__from) AS TIMESTAMP_NTZ)"),
        }
    )
    sp = _with_blocks(sp, "IF(__midnight, __first, __first + 1)", "__last", "__blocks")
    # A first day that starts at midnight is whole, hence among the blocks, unless it is also the last day.
    edges = f"IF(__midnight OR __first = __last, array({_code(_EDGE, '__last')}), array({_code(_EDGE, '__first')}, {_code(_EDGE, '__last')}))"
    return sp.withColumn("__code", F.explode(F.expr(f"concat(__blocks, {edges})"))).drop("__blocks", "__midnight")


def _probes(events: DataFrame) -> DataFrame:
    """Add one row for each block code that can hold the moment ``__at``."""
    probes = [_code(lv, f"shiftright(__day, {3 * lv})") for lv in range(_LEVELS)] + [_code(_EDGE, "__day")]
    return events.withColumn("__day", F.expr(_day("__at"))).withColumn("__code", F.explode(F.expr(f"array({', '.join(probes)})"))).drop("__day")


HOT_BLOCK = 100_000  # events of a block that one task joins


def _block_pairs(ev: DataFrame, sp: DataFrame, hot: int) -> DataFrame:
    """Events (``__key``, ``__at``) and spans (``__key``, ``__from``, ``__to``) that share a block code, each pair once."""
    sp, ev = _cut_spans(sp).drop("__first", "__last"), _probes(ev)
    parts = F.ceil(F.count(F.lit(1)) / F.lit(hot)).cast("int").alias("__parts")
    split = ev.groupBy(F.col("__key").alias("__k"), F.col("__code").alias("__c")).agg(parts).filter("__parts > 1")
    in_block = (F.col("__key") == F.col("__k")) & (F.col("__code") == F.col("__c"))
    part = F.coalesce(F.pmod(F.xxhash64("__event"), F.col("__parts")), F.lit(0))
    dealt = ev.join(split, in_block, "left").withColumn("__part", part).drop("__k", "__c", "__parts")
    every = F.explode(F.expr("sequence(0L, COALESCE(__parts, 1) - 1L)"))
    copies = sp.join(split, in_block, "left").withColumn("__part", every).drop("__k", "__c", "__parts")
    return dealt.join(copies, ["__key", "__code", "__part"])


def interval_join(
    events: DataFrame, spans: DataFrame, key: str, at: str, start: str, end: str, as_of: str | datetime, hot: int = HOT_BLOCK
) -> DataFrame:
    """Each event with every span of its key that contains it; an open end means ``as_of``.

    The result holds one row per (event, containing span). Whole days of a span become a few aligned day blocks, and
    events look for the blocks of their day, so a key with n events and m spans compares about its result and the spans
    that begin or end on an event's day, never n * m. Blocks with more than ``hot`` events are split: their events are
    dealt by content over as many parts as needed, and the block's spans go to each. Where only an extreme span per event
    is wanted use ``interval_min``, which never builds the pairs.
    """
    kept = [c for c in spans.columns if c != key]
    until = F.coalesce(F.col(end), ts(as_of))
    sp = spans.select(F.col(key).alias("__key"), F.col(start).alias("__from"), until.alias("__to"), F.struct(*kept).alias("__span"))
    ev = events.select(F.struct(*events.columns).alias("__event"), F.col(key).alias("__key"), F.col(at).alias("__at"))
    ev, sp = ev.filter("__key IS NOT NULL AND __at IS NOT NULL"), sp.filter("__key IS NOT NULL")
    # Rows of keys that only one side knows are cut off while they are single rows, before they become blocks.
    keys = events.select(F.col(key).alias("__key")).distinct().join(spans.select(F.col(key).alias("__key")).distinct(), "__key", "left_semi")
    met = _block_pairs(ev.join(keys, "__key", "left_semi"), sp.join(keys, "__key", "left_semi"), hot)
    inside = met.filter(f"__code < {_code(_EDGE, '0L')} OR __at BETWEEN __from AND __to")
    return inside.select("__event.*", *[F.col(f"__span.`{c}`") for c in kept])


def interval_min(
    events: DataFrame,
    spans: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    values: Sequence[str],
    event_id: str,
    as_of: str | datetime,
) -> DataFrame:
    """Events inside at least one span of their key, with the least of each span value.

    Equal to ``interval_join`` followed by ``min`` per event, without building the
    (event, span) pairs: the whole days of a span become aligned day blocks whose
    minima are taken once, so an event probes one row per block size however many
    spans its key has. Only the partial first and last day of a span compares clock
    times, again against spans already reduced to one row per clock time.
    ``event_id`` must identify an event.
    """
    mins = [F.min(v).alias(v) for v in values]
    active = events.select(F.col(key)).distinct()
    sp = spans.select(F.col(key), F.col(start).alias("__from"), F.coalesce(F.col(end), ts(as_of)).alias("__to"), *values)
    sp = _cut_spans(sp.join(active, key, "left_semi"))
    # On a first day only the start matters, on a last day only the end: open spans collapse to one row there.
    sp = sp.withColumns(
        {
            "__after": F.expr(f"IF(__code = {_code(_EDGE, '__first')}, __from, NULL)"),
            "__until": F.expr(f"IF(__code = {_code(_EDGE, '__last')}, __to, NULL)"),
        }
    )
    sp = sp.groupBy(key, "__code", "__after", "__until").agg(*mins)

    probe = _probes(events.select(event_id, key, F.col(at).alias("__at")))
    inside = "(__after IS NULL OR __at >= __after) AND (__until IS NULL OR __at <= __until)"
    best = probe.join(sp, [key, "__code"]).filter(inside).groupBy(event_id).agg(*mins)
    return events.join(best, event_id)


def extreme_rows(df: DataFrame, keys: Sequence[str], col: str, how: str = "max") -> DataFrame:
    """All rows that hold the greatest (or least) ``col`` of their key, ties included.

    The rank filter lets Spark cut each key to its leading rows before the
    shuffle, so a hot key sends a handful of rows, not all of them.
    """
    order = F.col(col).desc() if how == "max" else F.col(col).asc()
    ranked = df.filter(F.col(col).isNotNull()).withColumn("__rank", F.rank().over(W.partitionBy(*keys).orderBy(order)))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")
