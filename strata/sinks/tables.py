"""Table sinks and table-level maintenance without a transactional table format.

Parquet tables cannot be merged, deleted from or overwritten while being read, so every
rewrite goes to a fresh version folder, and only then is the table pointed at it
(``ALTER TABLE ... SET LOCATION`` + ``REFRESH``). A failed job leaves the old version in place.
Merges are published optimistically (``strata.sinks.versions``): of two writers that
started from the same rows, the second is run again on the rows of the first, or refused.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import merge
from strata.operators.quality import CLASSES
from strata.operators.schema import cast_with_errors
from strata.sinks import versions
from strata.sinks.versions import Publication, PublishConflict
from strata.sources.tables import table_exists

class TakenBack(RuntimeError):
    """A publication of partitions failed and was undone."""


#: Times a merge is run again when another writer was faster.
ATTEMPTS = 5


def overwrite_table(
    df: DataFrame, table: str, path: str | None = None, fmt: str | None = None
) -> None:
    """Overwrite a managed table, or an external one when ``path`` is given; without ``fmt`` in
    the session's default format (``spark.sql.sources.default``)."""
    writer = df.write.mode("overwrite")
    if fmt:
        writer = writer.format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def _same_schema(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """``df`` in the column order of ``table``; another set of columns or another type is refused,
    because the catalog would keep the old schema and hide or misread the new files."""
    known = {f.name.lower(): f for f in spark.table(table).schema.fields}
    given = {f.name.lower(): f for f in df.schema.fields}
    if set(known) != set(given):
        raise ValueError(f"columns of {table} are {sorted(known)}, given are {sorted(given)}")
    other = [n for n in known if known[n].dataType.simpleString() != given[n].dataType.simpleString()]
    if other:
        raise ValueError(f"types of {table} differ in {other}")
    return df.select(*[F.col(f"`{given[n].name}`").alias(f.name) for n, f in known.items()])


def _quoted(names: Sequence[str]) -> str:
    return ", ".join("`" + n.replace("`", "``") + "`" for n in names)


def _write_files(df: DataFrame, location: str, like: Publication) -> None:
    """The rows as files of a new folder; bucketed and sorted by the table's bucket columns, if it has any."""
    writer = df.write.mode("errorifexists").format(like.fmt)
    if not like.buckets:
        writer.save(location)
        return
    # bucketed files can only be written through a catalog entry, which goes again
    entry = f"strata_write_{uuid.uuid4().hex}"
    writer.bucketBy(like.buckets, *like.bucket_by).sortBy(*like.bucket_by).option("path", location).saveAsTable(entry)
    df.sparkSession.sql(f"DROP TABLE {entry}")


def _qualified(spark: SparkSession, path: str) -> str:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def _described(spark: SparkSession, table: str, name: str) -> str:
    return spark.sql(f"DESCRIBE FORMATTED {table}").filter(F.col("col_name") == name).collect()[0]["data_type"]


def _state(spark: SparkSession, table: str, base: str) -> Publication | None:
    """The table's last publication; a table (or a place) that was not made here is taken over as it is."""
    now = versions.last(spark, base)
    if not table_exists(spark, table):
        return now
    at = table_location(spark, table)
    if now is not None and _qualified(spark, now.location) == at:
        return now
    if now is not None and at.rsplit("/", 1)[-1].startswith("v-") and at.startswith(_qualified(spark, base) + "/"):
        return now  # a writer that published has not pointed the catalog at its version yet
    taken = Publication(now.number + 1 if now else 0, at, _described(spark, table, "Provider").lower())
    try:
        versions.claim(spark, base, taken)
        # appends lie in folders of their own
        spark.sql(f"ALTER TABLE {table} SET SERDEPROPERTIES ('recursiveFileLookup' = 'true')")
    except PublishConflict:
        return versions.last(spark, base)
    return taken


def _point(spark: SparkSession, table: str, base: str) -> str:
    """Point the catalog at the last publication, creating the table at first, and return its location."""
    while True:
        now = versions.last(spark, base)
        versions.show_added(spark, now)
        if not table_exists(spark, table):
            columns = spark.read.format(now.fmt).load(now.location).schema
            text = ", ".join(f"{_quoted([f.name])} {f.dataType.simpleString()}" for f in columns)
            by = _quoted(now.bucket_by)
            bucketed = f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {now.buckets} BUCKETS" if now.buckets else ""
            try:
                spark.sql(f"CREATE TABLE {table} ({text}) USING {now.fmt} OPTIONS (recursiveFileLookup 'true') {bucketed} LOCATION '{now.location}'")
            except AnalysisException as e:
                if e.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
                    raise
                continue
        elif table_location(spark, table) != _qualified(spark, now.location):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{now.location}'")
        spark.catalog.refreshTable(table)
        if versions.last(spark, base).number == now.number:
            return now.location


def _rows(spark: SparkSession, table: str, base: str) -> DataFrame:
    """The rows of the last publication, through the catalog (which knows the buckets)."""
    _point(spark, table, base)
    return spark.table(table)


def write_version(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    base_path: str,
    fmt: str | None = None,
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
) -> str:
    """Write ``df`` to a new version folder below ``base_path`` and point ``table`` at it.

    Creates the external table on first use (in ``fmt``, else the session's default format, and
    bucketed if asked for); later schema, format and buckets stay the same. Replaces whatever was
    published before; of two such writers the last one stays. Returns the new location.
    """
    base = base_path.rstrip("/")
    if table_exists(spark, table):
        df = _same_schema(spark, df, table)
    state = _state(spark, table, base)
    known = state if state is not None and table_exists(spark, table) else None
    like = known or Publication(0, "", fmt or spark.conf.get("spark.sql.sources.default"), None, tuple(bucket_by), buckets)
    location = f"{base}/v-{uuid.uuid4().hex}"
    _write_files(df, location, like)
    while True:
        number = state.number + 1 if state is not None else 0
        try:
            versions.claim(spark, base, replace(like, number=number, location=location, added=None))
            break
        except PublishConflict:
            state = versions.last(spark, base)
    _point(spark, table, base)
    return location


def _merged(spark: SparkSession, table: str, base: str, write: Callable[[Publication], Publication], attempts: int) -> str:
    """Publish what ``write`` makes of the last publication; again from the start if another writer was faster."""
    for left in reversed(range(attempts)):
        state = _state(spark, table, base)
        try:
            versions.claim(spark, base, replace(write(state), number=state.number + 1))
            return _point(spark, table, base)
        except PublishConflict:
            if not left:
                raise
    raise ValueError("attempts must be positive")


def stage(spark: SparkSession, df: DataFrame, base_path: str) -> DataFrame:
    """Write ``df`` once into a staging folder next to the table's versions and read it back.

    A merge source is read several times (key checks, the merge, partition lists); staging
    computes it once and cuts its lineage, so a retried stage never recomputes the source."""
    path = f"{base_path.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def _create(spark: SparkSession, source: DataFrame, table: str, base: str, fmt: str | None, bucket_by: Sequence[str], buckets: int) -> str | None:
    """Make the table of the source rows; None if another writer has made it meanwhile."""
    before = versions.last(spark, base)  # of a dropped table, if any
    like = Publication(before.number + 1 if before else 0, f"{base}/v-{uuid.uuid4().hex}", fmt or spark.conf.get("spark.sql.sources.default"), None, tuple(bucket_by), buckets)
    _write_files(source, like.location, like)
    try:
        versions.claim(spark, base, like)
    except PublishConflict:
        _point(spark, table, base)
        return None
    return _point(spark, table, base)


def upsert_table(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    base_path: str,
    check: bool = True,
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    heavy_share: float | None = None,
    attempts: int = ATTEMPTS,
    fmt: str | None = None,
) -> str:
    """Create on first run, otherwise update-all / insert-all on ``keys``.

    A table made with ``bucket_by`` the keys keeps its rows bucketed and sorted by them, so a merge with a
    large source shuffles the source only. ``heavy_share`` (say 1/64) finds the keys that
    many of the target's rows have with a frequent-items sketch and leaves those rows where they are.
    """
    base, keys = base_path.rstrip("/"), list(keys)
    if not table_exists(spark, table):
        location = _create(spark, source, table, base, fmt, bucket_by, buckets)
        if location is not None:
            return location
    source = stage(spark, _same_schema(spark, source, table), base)

    def write(state: Publication) -> Publication:
        target = _rows(spark, table, base)
        heavy = merge.frequent_keys(target, keys, heavy_share) if heavy_share else None
        if heavy is not None:
            heavy = stage(spark, heavy, base)  # one sketch pass, however many branches read it
        aligned = state.buckets > 0 and list(state.bucket_by) == keys
        result = merge.upsert(target, source, keys, check=check, heavy=heavy, aligned=aligned)
        location = f"{base}/v-{uuid.uuid4().hex}"
        _write_files(result, location, state)
        return replace(state, location=location, added=None)

    return _merged(spark, table, base, write, attempts)


def insert_new_table(
    spark: SparkSession, source: DataFrame, table: str, keys: Sequence[str], base_path: str, attempts: int = ATTEMPTS, fmt: str | None = None
) -> str:
    """Create on first run, otherwise insert the source rows whose key is new.

    Only the new rows are written, to a hidden folder inside the current version; one directory
    rename after the claim shows them all, so a job that fails before it adds none, whatever
    committer the session uses. Returns the table's location."""
    base = base_path.rstrip("/")
    if not table_exists(spark, table):
        location = _create(spark, source, table, base, fmt, (), 0)
        if location is not None:
            return location
    source = stage(spark, _same_schema(spark, source, table), base)

    def write(state: Publication) -> Publication:
        new = merge.new_rows(_rows(spark, table, base), source, keys)
        added = f"_adding-{uuid.uuid4().hex}"
        _write_files(new, f"{state.location}/{added}", state)
        return replace(state, added=added)

    return _merged(spark, table, base, write, attempts)


def replace_slice(spark: SparkSession, rows: DataFrame, table: str, column: str, value: str, base_path: str, attempts: int = ATTEMPTS) -> str:
    """Make ``rows`` the rows of a (small) table whose ``column`` is ``value``, whatever was there for it
    before; other slices stay. A load that runs again thus replaces itself."""
    base = base_path.rstrip("/")
    rows = rows.withColumn(column, F.lit(value))
    if not table_exists(spark, table):
        location = _create(spark, rows, table, base, None, (), 0)
        if location is not None:
            return location
    rows = stage(spark, _same_schema(spark, rows, table), base)

    def write(state: Publication) -> Publication:
        others = _rows(spark, table, base).filter(~F.col(column).eqNullSafe(value))
        location = f"{base}/v-{uuid.uuid4().hex}"
        _write_files(others.unionByName(rows), location, state)
        return replace(state, location=location, added=None)

    return _merged(spark, table, base, write, attempts)


def read_location(spark: SparkSession, location: str, schema, fmt: str = "parquet") -> DataFrame:
    """A version's rows by its folder, appended ones included."""
    return spark.read.schema(schema).format(fmt).option("recursiveFileLookup", True).load(location)


def table_location(spark: SparkSession, table: str) -> str:
    """The folder a table points at."""
    return _described(spark, table, "Location")


def refresh_table(spark: SparkSession, source: DataFrame, table: str, base_path: str) -> str:
    """Full refresh: the table becomes exactly the source; its schema and name are kept."""
    if not table_exists(spark, table):
        return write_version(spark, source, table, base_path)
    return write_version(spark, merge.refresh(spark.table(table), source), table, base_path)


def delete_all_table(spark: SparkSession, table: str, base_path: str) -> str:
    """Empty the table, schema kept."""
    return write_version(spark, merge.delete_all(spark.table(table)), table, base_path)


def expire_versions(spark: SparkSession, table: str, base_path: str, keep_hours: float = 168) -> list[str]:
    """Delete version and staging folders that nothing points at and that are older than
    ``keep_hours`` (longer than any reader or writer runs). Returns their names."""
    base = base_path.rstrip("/")
    used = {table_location(spark, table)}
    if (now := versions.last(spark, base)) is not None:
        used.add(_qualified(spark, now.location))
    if not spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = '# Partition Information'").isEmpty():
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
            spec = [part.split("=", 1) for part in row[0].split("/")]
            clause = ", ".join(f"{_quoted([k])} = {_sql_text(_unescaped(spark, v))}" for k, v in spec)
            at = spark.sql(f"DESCRIBE FORMATTED {table} PARTITION ({clause})").filter("col_name = 'Location'").collect()
            used.add(at[0]["data_type"].rsplit("/", len(spec))[0])
    gone = []
    for name, changed in versions.folders(spark, base):
        old = changed < (time.time() - keep_hours * 3600) * 1000
        if old and name.startswith(("v-", "_staging-")) and _qualified(spark, f"{base}/{name}") not in used:
            versions.delete(spark, f"{base}/{name}")
            gone.append(name)
    return sorted(gone)


def _unescaped(spark: SparkSession, text: str) -> str:
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(text)


def write_quality_split(
    classified: DataFrame, path: str, class_col: str = "quality_class"
) -> dict[str, int]:
    """Write every class in one scan and one job, partitioned by class, and return the row
    count of each class observed during that same write."""
    obs = Observation("quality_split")
    counts = [F.count(F.when(F.col(class_col) == c, 1)).alias(c) for c in CLASSES]
    observed = classified.observe(obs, F.count(F.lit(1)).alias("total"), *counts)
    observed.write.mode("errorifexists").partitionBy(class_col).parquet(path)
    return {k: int(v) for k, v in obs.get.items()}


def read_quality_class(
    spark: SparkSession, path: str, cls: str, columns: Sequence[str], class_col: str = "quality_class"
) -> DataFrame:
    """One class of a split written by ``write_quality_split`` (partition-pruned)."""
    return spark.read.parquet(path).filter(F.col(class_col) == cls).select(*columns)


#: Kind of a row of a typed split, the columns that did not cast, and their texts.
SPLIT_KIND, SPLIT_ERRORS, SPLIT_RAW = "cast_kind", "cast_errors", "cast_raw"
GOOD, REJECTED = "good", "rejected"


def write_typed_split(df: DataFrame, schema: T.StructType, path: str) -> dict[str, int]:
    """Cast ``df`` to ``schema`` once and write good and rejected rows in one job, partitioned by which
    they are. Rejected rows keep the texts that did not cast. Returns the counts observed in that write:
    ``rows``, ``rejected``, and per column of the schema its failures."""
    given = {c.lower(): c for c in df.columns}
    checked = [f.name for f in schema.fields if df.schema[given[f.name.lower()]].dataType != f.dataType]
    # the input rides along below a name no schema has, and is kept where a column failed
    carried = df.withColumn("__strata_raw", F.struct(*[F.col(f"`{given[c.lower()]}`").cast("string").alias(c) for c in checked] or [F.lit(None).cast("string").alias("none")]))
    wide = T.StructType([*schema.fields, T.StructField("__strata_raw", carried.schema["__strata_raw"].dataType)])
    typed = cast_with_errors(carried, wide, SPLIT_ERRORS)
    ok = F.size(SPLIT_ERRORS) == 0
    kind = F.when(ok, GOOD).otherwise(REJECTED)
    split = typed.withColumns({SPLIT_KIND: kind, SPLIT_RAW: F.when(~ok, F.col("__strata_raw"))}).drop("__strata_raw")
    obs = Observation("typed_split")
    counts = [F.count_if(F.array_contains(SPLIT_ERRORS, f.name)).alias(f"f{i}") for i, f in enumerate(schema.fields)]
    observed = split.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(SPLIT_KIND) == REJECTED).alias("rejected"), *counts)
    observed.write.mode("errorifexists").partitionBy(SPLIT_KIND).parquet(path)
    got = obs.get
    return {"rows": got["rows"], "rejected": got["rejected"]} | {f.name: got[f"f{i}"] for i, f in enumerate(schema.fields)}


def read_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The good rows of a typed split (partition-pruned)."""
    return spark.read.parquet(path).filter(F.col(SPLIT_KIND) == GOOD).select(*[F.col(f"`{n}`") for n in schema.names])


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The rejected rows of a typed split: typed columns, failing names, and the texts as given."""
    return spark.read.parquet(path).filter(F.col(SPLIT_KIND) == REJECTED).drop(SPLIT_KIND)


#: Types whose text in a partition folder and in the catalog gives back exactly the value.
PARTITION_TYPES = {"string", "boolean", "date", "tinyint", "smallint", "int", "bigint"}
#: Partitions one upsert may touch; each is one catalog entry on the driver.
MAX_TOUCHED = 10_000


def _sql_text(value) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _by_partition(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Group rows of a partition into few tasks before a partitioned write (few files per
    partition instead of one per task and partition); AQE splits a skewed partition and
    merges small ones (``REBALANCE``)."""
    return df.hint("rebalance", *parts)


def _touched(src: DataFrame, parts: Sequence[str], limit: int) -> list[dict[str, str]]:
    """The partitions of ``src`` as texts; refuses what a partition cannot hold exactly."""
    kinds = {p: src.schema[p].dataType.simpleString() for p in parts}
    if bad := {p: k for p, k in kinds.items() if k not in PARTITION_TYPES}:
        raise ValueError(f"no partition columns of these types: {bad}")
    rows = src.select(*[F.col(p).cast("string").alias(p) for p in parts]).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} partitions touched; partition by a coarser column")
    if any(v is None or v == "" for r in rows for v in r):
        raise ValueError("NULL and empty partition values are not supported")
    return [r.asDict() for r in rows]


def _folder(spark: SparkSession, spec: dict[str, str], parts: Sequence[str]) -> str:
    """Spark's own name of a partition's folder."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join(f"{escape(p)}={escape(spec[p])}" for p in parts)


def upsert_partitioned_table(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    base_path: str,
    check: bool = True,
    max_touched: int = MAX_TOUCHED,
) -> list[dict[str, str]]:
    """Create-or-upsert a table partitioned by ``partition_by``, rewriting only the
    partitions the source touches (copy-on-write per partition).

    The partition columns must be part of the merge key, so that a key's rows live in one
    partition and no match crosses partitions. The touched partition values are read from the
    staged source; types, NULL and empty values that a partition cannot hold exactly, and more
    than ``max_touched`` of them, are refused before anything is written. They filter the
    target as constants, so other partitions are not listed or read. Each run writes the
    touched partitions once (``partitionBy``) into a new version folder, checks that every one
    is there, claims the publication (``PublishConflict`` if another writer was faster), and repoints
    those partitions in the catalog; if a repoint fails, the ones made before are taken back and
    the old version stays. After a crash between these steps ``finish_publication`` completes them,
    and other writers are refused until then. Returns the touched values as text.
    """
    parts = list(partition_by)
    if not set(parts) <= set(keys):
        raise ValueError("partition columns must be part of the merge key")
    base = base_path.rstrip("/")
    exists = table_exists(spark, table)
    before = versions.last(spark, base)
    if before is not None and not versions.is_finished(spark, base, before):
        raise PublishConflict(f"publication {before.number} of {table} is under way or was broken off; see finish_publication")
    if exists:
        source = _same_schema(spark, source, table)
    src = stage(spark, source, base_path)
    touched = _touched(src, parts, max_touched)
    version = f"{base}/v-{uuid.uuid4().hex}"
    published = Publication(before.number + 1 if before else 0, version)
    if not exists:
        _by_partition(src, parts).write.mode("errorifexists").partitionBy(*parts).parquet(version)
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)
        names = ", ".join(f"`{p}`" for p in parts)
        versions.claim(spark, base, published)
        spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet PARTITIONED BY ({names}) LOCATION '{version}'")
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        return touched
    if not touched:
        return touched
    # constants prune the target's partitions; several columns together may still hold a few more
    current = spark.table(table)
    for p in parts:
        kind = source.schema[p].dataType
        current = current.filter(F.col(f"`{p}`").isin([F.lit(v).cast(kind) for v in sorted({t[p] for t in touched})]))
    if len(parts) > 1:
        current = current.join(src.select(*parts).distinct(), parts, "left_semi")
    merged = merge.upsert(current, src, keys, check=check)
    _by_partition(merged, parts).write.mode("errorifexists").partitionBy(*parts).parquet(version)
    folders = [_folder(spark, spec, parts) for spec in touched]
    if missing := [f for f in folders if not versions.exists(spark, f"{version}/{f}")]:
        raise RuntimeError(f"partitions missing from {version}: {missing[:5]}")
    # two writers from one publication: the second stops here and has changed nothing
    versions.claim(spark, base, replace(published, partitions=tuple(folders)))
    try:
        _repoint(spark, table, parts, touched, folders, version)
    except TakenBack:
        versions.mark_finished(spark, base, published.number)  # nothing of it is left to finish
        raise
    versions.mark_finished(spark, base, published.number)
    return touched


def finish_publication(spark: SparkSession, table: str, partition_by: Sequence[str], base_path: str) -> None:
    """Repoint the partitions of a publication whose writer broke off between its claim and its last repoint."""
    base = base_path.rstrip("/")
    now = versions.last(spark, base)
    if now is None or versions.is_finished(spark, base, now):
        return
    touched = [{k: _unescaped(spark, v) for k, v in (x.split("=", 1) for x in folder.split("/"))} for folder in now.partitions]
    _repoint(spark, table, list(partition_by), touched, list(now.partitions), now.location)
    versions.mark_finished(spark, base, now.number)


def _repoint(spark: SparkSession, table: str, parts: Sequence[str], touched: list[dict[str, str]], folders: list[str], version: str) -> None:
    """Point the touched partitions at ``version``; on an error take back those already moved."""
    clauses = ["PARTITION (" + ", ".join(f"`{p}` = {_sql_text(spec[p])}" for p in parts) + ")" for spec in touched]
    existing = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    where = {}
    for clause, folder in zip(clauses, folders):
        if folder in existing:
            rows = spark.sql(f"DESCRIBE FORMATTED {table} {clause}").filter("col_name = 'Location'").collect()
            where[clause] = rows[0]["data_type"]
    done = []
    try:
        for clause, folder in zip(clauses, folders):
            if clause in where:
                spark.sql(f"ALTER TABLE {table} {clause} SET LOCATION {_sql_text(f'{version}/{folder}')}")
                done.append(clause)
        added = " ".join(f"{c} LOCATION {_sql_text(f'{version}/{f}')}" for c, f in zip(clauses, folders) if c not in where)
        if added:
            spark.sql(f"ALTER TABLE {table} ADD {added}")
    except Exception as e:
        for clause in done:
            spark.sql(f"ALTER TABLE {table} {clause} SET LOCATION {_sql_text(where[clause])}")
        raise TakenBack(f"partitions of {table} keep their old version") from e
    finally:
        spark.catalog.refreshTable(table)
