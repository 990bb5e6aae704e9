"""Change detection and keyed upserts."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from ledgersync.functions.clock import as_datetime, ts
from ledgersync.operators.joins import lookup
from ledgersync.operators.windows import latest_per_key
from ledgersync.registry import ObjectSpec
from ledgersync.session import scratch_path, stored
from ledgersync.sources.folders import names_below, remove_folder

# Fixed value: the attribute that holds the opportunity id.
OPPORTUNITY_ATTRIBUTE = 23

_NULL_KEY_SPREAD = 4096

CHANGED, UNCHANGED = "Data Changed", "No Changes"


def eav_values(fields: DataFrame, values: DataFrame, attr_oid: int, name: str, default: str | None = "NULL") -> DataFrame:
    """(ref_oid, value) pairs of one attribute, de-duplicated; a missing value becomes ``default``."""
    defined = fields.filter(F.col("oid") == attr_oid).select(F.col("oid").alias("genf_oid"))
    text = F.col("field_value") if default is None else F.coalesce("field_value", F.lit(default))
    rows = values.filter((F.col("genf_oid") == attr_oid) & F.col("ref_oid").isNotNull())
    return rows.join(defined, "genf_oid", "left_semi").select("ref_oid", text.alias(name)).distinct()


def eav_resolve(
    fields: DataFrame,
    values: DataFrame,
    base: DataFrame,
    attr_oid: int = OPPORTUNITY_ATTRIBUTE,
    base_key: str = "contract_oid",
    name: str = "opportunity",
    default: str | None = "NULL",
    how: str = "inner",
) -> DataFrame:
    """Add one attribute to ``base``; the inner form drops rows without an attribute row."""
    pairs = eav_values(fields, values, attr_oid, name, default)
    return lookup(base, pairs, [(base_key, "ref_oid")], {name: name}, how)


def snapshot_diff(
    current: DataFrame,
    previous: DataFrame,
    key: str,
    measures: Sequence[str | tuple[str, str]],
    *,
    null_safe: bool = False,
    new_rows: bool = False,
    status: str = "change_status",
) -> DataFrame:
    """Label each current row by comparing its measures with the stored row.

    A measure is a column, or a pair ``(a, b)`` compared as ``a - b``. By default a
    NULL on either side is no change, so rows not stored yet are never flagged;
    ``null_safe`` treats NULL as a value and ``new_rows`` flags missing rows.
    """
    names = list(dict.fromkeys(c for m in measures for c in ((m,) if isinstance(m, str) else m)))
    stored = previous.selectExpr(f"`{key}` AS __key", *[f"`{c}` AS `__p_{c}`" for c in names])
    joined = current.join(stored, F.expr(f"`{key}` = __key"), "left")

    def side(m: str | tuple[str, str], p: str) -> str:
        return f"`{p}{m}`" if isinstance(m, str) else f"(`{p}{m[0]}` - `{p}{m[1]}`)"

    differs = "NOT ({} <=> {})" if null_safe else "{} <> {}"
    changed = "(" + " OR ".join(differs.format(side(m, ""), side(m, "__p_")) for m in measures) + ")"
    if null_safe:
        changed = f"(__key IS NOT NULL AND {changed})"
    if new_rows:
        changed = f"({changed} OR __key IS NULL)"
    out = joined.withColumn(status, F.expr(f"CASE WHEN {changed} THEN '{CHANGED}' ELSE '{UNCHANGED}' END"))
    return out.drop("__key", *[f"__p_{c}" for c in names])


def _salt(df: DataFrame, key: str) -> str:
    """Rows without a key match nothing; spread them, or they would all meet in one task."""
    return f"IF(`{key}` IS NULL, pmod(xxhash64({', '.join(f'`{c}`' for c in df.columns)}), {_NULL_KEY_SPREAD}L), 0L)"


def _checked(source: DataFrame, key: str, on_null_key: str, salt: str | None = None) -> DataFrame:
    """``source`` with a failing look at each row of its key: the second one, and with ``'error'`` the first without key.

    The rows are looked at where they lie by key, with ``salt`` (a column) by both, as the join that follows needs them. The
    check asks for the row's number, or Spark would move it below the source's joins, where it met rows that these drop.
    """
    if on_null_key == "drop":
        source = source.filter(F.col(key).isNotNull())
    by = [key] if salt is None else [key, salt]
    numbered = source.withColumn("__nth", F.row_number().over(W.partitionBy(*by).orderBy(key)))
    keyless = f"IF(__nth > 0, CAST(raise_error('source row without {key}') AS BOOLEAN), FALSE)" if on_null_key == "error" else "TRUE"
    again = f"CAST(raise_error(concat('several source rows for {key} = ', CAST(`{key}` AS STRING))) AS BOOLEAN)"
    return numbered.filter(f"CASE WHEN `{key}` IS NULL THEN {keyless} WHEN __nth > 1 THEN {again} ELSE TRUE END").drop("__nth")


def one_row_per_key(
    source: DataFrame, key: str, on_duplicate: str = "error", on_null_key: str = "insert", latest_by: Sequence[str] = (), staged: bool = False
) -> DataFrame:
    """Bring an upsert source to at most one row per key.

    ``on_duplicate='error'`` fails the job when a key repeats, ``'latest'`` keeps the
    row with the greatest ``latest_by`` (the remaining columns break ties). Rows
    with a NULL key match nothing: ``'insert'`` keeps every one, ``'drop'`` removes
    them and ``'error'`` fails. The failing checks number the rows of a key where they
    lie by key, in one pass with rows without key spread by content; the latest row is cut to
    one per key and task first, and NULL-key rows are then not shuffled at all. A source that
    is looked at more than once is stored first, so that it is computed
    once; ``staged`` says that its rows already lie in files.
    """
    if on_duplicate not in ("error", "latest") or on_null_key not in ("insert", "drop", "error"):
        raise ValueError(f"on_duplicate={on_duplicate!r}, on_null_key={on_null_key!r}")
    if on_duplicate == "latest" and not latest_by:
        raise ValueError("latest_by is required")
    cols = source.columns
    if on_duplicate == "error":
        spread = on_null_key == "insert"
        salted = source.withColumn("__salt", F.expr(_salt(source, key))) if spread else source
        return _checked(salted, key, on_null_key, "__salt" if spread else None).select(*cols)
    once = on_null_key == "drop"
    if not (staged or once or any(isinstance(f.dataType, NullType) for f in source.schema.fields)):  # files hold no untyped columns
        source = stored(source, "upsert-source")
    keyed, keyless = source.filter(F.col(key).isNotNull()), source.filter(F.col(key).isNull())
    order = [F.col(c).desc_nulls_last() for c in [*latest_by, *[c for c in cols if c not in latest_by and c != key]]]
    keyed = latest_per_key(keyed, [key], order)
    if on_null_key == "drop":
        return keyed
    if on_null_key == "error":
        # Counted first: a failing filter of its own would move below the source's joins and meet rows that these drop.
        failed = F.expr(f"IF(__n > 0, CAST(raise_error(concat('source row without {key}: ', CAST(__n AS STRING))) AS BOOLEAN), FALSE)")
        none = keyless.agg(F.expr("COUNT(1) AS __n")).filter(failed)
        keyless = none.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in source.schema.fields])
    return keyed.unionByName(keyless)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update_cols: Sequence[str] | None = None,
    insert_cols: Sequence[str] | None = None,
    *,
    on_duplicate: str = "error",
    on_null_key: str = "insert",
    latest_by: Sequence[str] = (),
    defaults: Mapping[str, int | float] | None = None,
    newer_by: str | Sequence[str] | None = None,
    staged: bool = False,
) -> DataFrame:
    """Matched rows take ``update_cols``, new rows take ``insert_cols``, other rows stay; nothing is deleted.

    ``defaults`` replaces NULLs of the source on write. With ``newer_by`` (columns, NULLs
    least) a matched row is only updated when the source's are not below the stored ones. ``staged`` as for ``one_row_per_key``.
    """
    cols = target.columns
    updates = set(update_cols if update_cols is not None else [c for c in cols if c != key])
    inserts = set(insert_cols if insert_cols is not None else cols) | {key}
    needed = [c for c in dict.fromkeys([*cols, *latest_by]) if c in source.columns]
    lacking = [c for c in cols if c in (updates | inserts) and c not in source.columns]
    if lacking:
        raise ValueError(f"source lacks {lacking}")
    src = source.select(*needed)
    if on_duplicate == "error" and on_null_key == "insert":
        # checked where the join below needs its rows, so they are shuffled once
        salted = _checked(src.withColumn("__salt", F.expr(_salt(src, key))), key, on_null_key, "__salt")
    else:
        src = one_row_per_key(src, key, on_duplicate, on_null_key, latest_by, staged)
        salted = src.withColumn("__salt", F.expr(_salt(src, key)))
    filled = defaults or {}
    s = salted.selectExpr(
        *[f"COALESCE(`{c}`, {filled[c]}) AS `__s_{c}`" if c in filled else f"`{c}` AS `__s_{c}`" for c in src.columns],
        "TRUE AS __in_source",
        "__salt AS __s_salt",
    )
    t = target.selectExpr("*", "TRUE AS __in_target", f"{_salt(target, key)} AS __t_salt")
    joined = t.join(s, F.expr(f"`{key}` = `__s_{key}` AND __t_salt = __s_salt"), "full")
    take = "__in_source"
    if newer_by:
        by = [newer_by] if isinstance(newer_by, str) else list(newer_by)
        # structs compare field by field, NULL before all values
        take = f"__in_source AND struct({', '.join(f'`__s_{c}`' for c in by)}) >= struct({', '.join(f'`{c}`' for c in by)})"

    def merged(c: str, kind: str) -> str:
        new = f"CAST(`__s_{c}` AS {kind})" if c in src.columns else f"CAST(NULL AS {kind})"
        inserted = new if c in inserts else f"CAST(NULL AS {kind})"
        updated = f"WHEN {take} THEN {new}" if c in updates else ""
        return f"CASE WHEN __in_target IS NULL THEN {inserted} {updated} ELSE `{c}` END AS `{c}`"

    return joined.selectExpr(*[merged(f.name, f.dataType.simpleString()) for f in target.schema.fields])


def merge_object(target: DataFrame, source: DataFrame, spec: ObjectSpec, **options: object) -> DataFrame:
    """``merge_upsert`` by the object's registered key, update list and defaults."""
    return merge_upsert(
        target.select(*spec.columns),
        source.select(*spec.columns),
        spec.key,
        spec.update_columns,
        spec.columns,
        defaults=spec.defaults,
        **options,  # type: ignore[arg-type]
    )


def incremental_pull(df: DataFrame, col: str, watermark: str | datetime | None, overlap: timedelta, until: str | datetime | None = None) -> DataFrame:
    """Rows changed since the stored high-watermark minus an overlap.

    Polling more often than the overlap re-reads rows, which the keyed merge absorbs.
    """
    if watermark is not None:
        df = df.filter(F.col(col) >= ts(as_datetime(watermark) - overlap))
    return df if until is None else df.filter(F.col(col) <= ts(until))


def with_bucket(df: DataFrame, key: str, buckets: int, name: str = "bucket") -> DataFrame:
    """Add the storage bucket of each row; rows without a key are spread by their content."""
    keyless = F.when(F.col(key).isNull(), F.struct(*[F.col(c) for c in df.columns]))
    return df.withColumn(name, F.pmod(F.xxhash64(F.col(key).cast("string"), keyless), F.lit(buckets)).cast("int"))


def _laid_out(df: DataFrame, key: str, splits: int) -> DataFrame:
    """One shuffle that lines files up with buckets, ``splits`` tasks per bucket."""
    split = F.pmod(F.hash(F.col(key)), F.lit(splits))
    return df.repartition(F.col("bucket"), split)


def _beside(path: str, name: str) -> str:
    return f"{path.rstrip('/')}-{name}"


def write_keyed(df: DataFrame, path: str, key: str, buckets: int = 64, splits: int = 1) -> None:
    """Write a merge target partitioned by key bucket, so upserts rewrite only touched buckets.

    Choose ``buckets`` for about a gigabyte per bucket; ``splits`` writes a bucket
    by several tasks where it must be larger. Key, bucket count and columns are stored
    beside the target (``<path>-layout``), where upserts read them.
    """
    spark = df.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.createDataFrame([(key, buckets, columns)], "key string, buckets int, columns string").coalesce(1).write.mode("errorifexists").parquet(_beside(path, "layout"))
    out = _laid_out(with_bucket(df, key, buckets), key, splits)
    out.write.mode("errorifexists").partitionBy("bucket").parquet(path)


def layout_of(spark: SparkSession, path: str, key: str) -> tuple[int, str]:
    """Bucket count and columns of a ``write_keyed`` folder, which must be keyed by ``key``."""
    stored = spark.read.parquet(_beside(path, "layout")).first()
    if stored.key != key:
        raise ValueError(f"{path} is keyed by {stored.key}, not {key}")
    return stored.buckets, stored.columns


def _publish(spark: SparkSession, staged: str, path: str) -> None:
    """Replace the staged buckets in the target."""
    (
        spark.read.parquet(staged)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket")
        .parquet(path)
    )


def _read_if_there(spark: SparkSession, path: str, **options: str) -> DataFrame | None:
    try:
        return spark.read.options(**options).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _mark(spark: SparkSession, root: str, target: str) -> None:
    """Note which target the stage is being published to; '' when it is done."""
    spark.createDataFrame([(target,)], "target string").coalesce(1).write.mode("overwrite").parquet(f"{root}/publishing")


def upsert_into_path(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    spec: ObjectSpec,
    splits: int = 1,
    stage: str | None = None,
    **options: object,
) -> None:
    """Merge ``source`` into a ``write_keyed`` folder, rewriting only the touched buckets.

    The source and the merged buckets are staged below ``stage`` (default: a new
    folder in the shared scratch space; repeated jobs should pass one to overwrite)
    first: the source is computed once, and the target is replaced partition by
    partition from finished files. A run that stops while publishing is finished
    from its staged buckets by the next run with the same ``stage``; a stage that
    was publishing to another target is refused. While a run publishes, readers of
    the folder can see some buckets new and others old.
    """
    root = stage or scratch_path(spark, "upsert")
    staged_source, staged = f"{root}/source", f"{root}/merged"
    buckets, columns = layout_of(spark, path, spec.key)
    marked = _read_if_there(spark, f"{root}/publishing")
    if marked is not None and (was := marked.first().target):  # an earlier run stopped while publishing: its staged buckets are complete
        if was != path:
            raise ValueError(f"{root} holds an unfinished publication to {was}")
        _publish(spark, staged, path)
        _mark(spark, root, "")
    with_bucket(source, spec.key, buckets).write.mode("overwrite").parquet(staged_source)
    src = spark.read.parquet(staged_source)
    touched = [r[0] for r in src.select("bucket").distinct().collect()]  # at most ``buckets`` small numbers
    if not touched:
        return
    target = spark.read.schema(f"{columns}, bucket int").parquet(path).filter(F.col("bucket").isin(touched)).select(*spec.columns)
    merged = with_bucket(merge_object(target, src.drop("bucket"), spec, staged=True, **options), spec.key, buckets)
    _laid_out(merged, spec.key, splits).write.mode("overwrite").partitionBy("bucket").parquet(staged)
    _mark(spark, root, path)
    _publish(spark, staged, path)
    _mark(spark, root, "")


def _batch_name(run: str) -> str:
    return f"b{hashlib.sha256(run.encode()).hexdigest()[:16]}"


def append_changes(changes: DataFrame, path: str, spec: ObjectSpec, run: str, latest_by: Sequence[str], on_null_key: str = "drop") -> None:
    """Append a batch of changes, its newest row per key, to the change folder of a ``write_keyed`` target.

    ``run`` names the batch: appended again it replaces itself. Rows without a key match nothing: they are dropped, or with
    ``on_null_key='insert'`` every one is kept in a folder of its own, which ``compact`` leaves alone.
    """
    if on_null_key not in ("drop", "insert"):
        raise ValueError(f"on_null_key={on_null_key!r}")
    rows = changes.select(*spec.columns)
    newest = one_row_per_key(rows, spec.key, "latest", "drop", latest_by)
    newest.write.mode("overwrite").parquet(f"{_beside(path, 'changes')}/batch={_batch_name(run)}")
    if on_null_key == "insert":
        rows.filter(F.col(spec.key).isNull()).write.mode("overwrite").parquet(f"{_beside(path, 'keyless')}/batch={_batch_name(run)}")


def _merged_batches(spark: SparkSession, path: str) -> list[str]:
    """Batches that ``compact`` has merged and not yet removed."""
    merged = _read_if_there(spark, _beside(path, "compacted"))
    return [] if merged is None else [r.batch for r in merged.distinct().collect()]


def _pending(spark: SparkSession, path: str) -> list[str]:
    """Batches appended since the last ``compact``, from one listing of the change folder."""
    done = set(_merged_batches(spark, path))
    return [b for b in names_below(spark, _beside(path, "changes"), "batch=") if b not in done]


def _read_batches(spark: SparkSession, path: str, batches: Sequence[str]) -> DataFrame:
    return spark.read.parquet(*[f"{_beside(path, 'changes')}/batch={b}" for b in batches])


def keyed_state(spark: SparkSession, path: str, spec: ObjectSpec, schema: str, latest_by: Sequence[str]) -> DataFrame:
    """The stored rows with all appended changes, in whatever order these came: per key the greatest by ``latest_by``.

    Only batches that aren't merged yet are opened. Kept rows without a key follow as they are.
    """
    out = spark.read.schema(schema).parquet(path).select(*spec.columns)
    if batches := _pending(spark, path):
        changes = _read_batches(spark, path, batches)
        out = merge_object(out, changes, spec, on_duplicate="latest", on_null_key="drop", latest_by=latest_by, newer_by=latest_by)
    keyless = [f"{_beside(path, 'keyless')}/batch={b}" for b in names_below(spark, _beside(path, "keyless"), "batch=")]
    return out.unionByName(spark.read.schema(schema).parquet(*keyless).select(*spec.columns)) if keyless else out


def compact(spark: SparkSession, path: str, spec: ObjectSpec, latest_by: Sequence[str], stage: str | None = None) -> None:
    """Merge the appended changes into the target and note their batches as merged.

    A batch merged twice changes nothing, so a run that stops in between is simply run again. Batches that an earlier
    ``compact`` merged are removed: whoever began to read before it has had a whole interval to finish.
    """
    earlier, batches = _merged_batches(spark, path), _pending(spark, path)
    if batches:
        named = _read_batches(spark, path, batches)
        upsert_into_path(spark, path, named, spec, stage=stage, on_duplicate="latest", on_null_key="drop", latest_by=list(latest_by), newer_by=list(latest_by))
        spark.createDataFrame([(b,) for b in batches], "batch string").coalesce(1).write.mode("append").parquet(_beside(path, "compacted"))
    for b in earlier:
        remove_folder(spark, f"{_beside(path, 'changes')}/batch={b}")
    if earlier:  # merged again if this is lost half way, which changes nothing
        spark.createDataFrame([(b,) for b in batches], "batch string").coalesce(1).write.mode("overwrite").parquet(_beside(path, "compacted"))
