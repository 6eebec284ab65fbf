"""The document table, the graph tables and the bot scores as Parquet folders.

Every write belongs to a batch and replaces it whole, so a batch that is run again after a lost
executor or driver leaves the tables as a single run would, also where the second run chose other
rows or days. No write reads the graph tables: a vertex may stand in several batches, and readers
take each once.

Documents and the index of their repeat keys are committed together, as versions (``versions``):
compaction, retention and appending streams may run side by side, and a reader sees one version.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlark.operators import graph
from postlark.operators.dedup import stored_keys
from postlark.operators.documents import SCORE_FIELDS, retain, write_back_scores
from postlark.session import stage
from postlark.sources import keyindex, versions
from postlark.sources.versions import Conflict, Part, Version

DOCUMENTS = "documents"
INDEXED = (DOCUMENTS, keyindex.KEYS, keyindex.FILTERS)
NO_DAY = "__HIVE_DEFAULT_PARTITION__"

_USER = "struct<id:bigint,screen_name:string,name:string,location:string>"
_METADATA = "struct<avg_tweet_freq:bigint,avg_tweet_reg:bigint,tweet_freq_variance:bigint,is_bot:boolean>"
_TIMES = "first_ms bigint, last_ms bigint"

SCHEMAS = {
    "documents": (
        "post_id bigint, source string, tweet_id string, text string, favorites string, place string, "
        f"user {_USER}, phone string, email string, link string, hash string, created_at timestamp, "
        f"third_party boolean, metadata {_METADATA}, is_retweet boolean, created_date date"
    ),
    "persons": "id string, name string, person_key string",
    "posts": (
        "id string, text string, created_ms bigint, tags array<string>, phone string, email string, "
        "link string, hash string, third_party boolean, post_key string"
    ),
    "tags": "name string",
    "posted": f"person_key string, tweet_id string, relation string, {_TIMES}",
    "tagged": f"tweet_id string, tag string, {_TIMES}",
    "counts": "messages bigint, rejected bigint, late bigint, stored bigint",
    "scores": "user_id bigint, avg_tweet_freq bigint, avg_tweet_reg bigint, tweet_freq_variance bigint, is_bot boolean",
}
VERTEX_KEYS = {"persons": "person_key", "posts": "post_key", "tags": "name"}
EDGE_KEYS = {"posted": ["person_key", "tweet_id", "relation"], "tagged": ["tweet_id", "tag"]}


def create(spark: SparkSession, root: str) -> None:
    """Lay down empty tables so that readers find them before the first batch."""
    for name, schema in SCHEMAS.items():
        if name != DOCUMENTS:
            spark.createDataFrame([], f"{schema}, batch_id bigint").write.mode("append").partitionBy("batch_id").parquet(f"{root}/{name}")


def read(spark: SparkSession, root: str, name: str, version: Version | None = None) -> DataFrame:
    """A table as it is now; the documents of a version, by default of the newest."""
    schema = f"{SCHEMAS[name]}, batch_id bigint"
    if name == DOCUMENTS:
        return _documents(spark, root, (version or versions.read_version(spark, root)).of(DOCUMENTS))
    return spark.read.schema(schema).parquet(f"{root}/{name}")


def _documents(spark: SparkSession, root: str, parts: list[Part]) -> DataFrame:
    schema = f"{SCHEMAS[DOCUMENTS]}, batch_id bigint"
    rows = versions.read_parts(spark, root, DOCUMENTS, schema, parts)
    return rows.select(*spark.createDataFrame([], schema).columns)


def read_batch(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """The documents of a batch."""
    return _documents(spark, root, [p for p in versions.read_version(spark, root).of(DOCUMENTS) if p.batch == batch_id])


def write_batch(df: DataFrame, root: str, name: str, batch_id: int) -> None:
    """Replace the batch's folder."""
    written = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
    written.parquet(f"{root}/{name}/batch_id={batch_id}")


def other_batches(df: DataFrame, batch_id: int) -> DataFrame:
    """What was there before the batch, also when the batch runs again."""
    return df.filter(F.col("batch_id") != batch_id)


def append_documents(documents: DataFrame, root: str, batch_id: int) -> Version:
    """Insert the documents of a batch with their repeat keys, cut by day so that retention drops whole days."""
    spark = documents.sparkSession
    rows = documents.withColumns({"created_date": F.to_date("created_at"), "batch_id": F.lit(batch_id).cast("bigint")})
    parts = versions.write_parts(rows, root, DOCUMENTS, cut="created_date", batches="batch_id")
    keyed = stored_keys(_documents(spark, root, parts), "created_at").select(*keyindex.key_hashes(F.col("repeat_key")), "created_at")
    once = keyed.groupBy("k1", "k2").agg(F.when(~F.max(F.col("created_at").isNull()), F.max("created_at")).alias("created_at"))
    parts += keyindex.write_keys(once, root, batch_id)
    return versions.commit(spark, root, versions.replacing_batch(batch_id, INDEXED, parts))


FILE_BYTES = 128_000_000


def _days_merged(spark: SparkSession, root: str, parts: list[Part]) -> DataFrame:
    """The documents of some parts with few tasks for each day, none of which reads two days: a day's files are read one
    after the other, so nothing is shuffled. Two tasks at least, since Spark makes one task of a union of single ones."""
    of_day: dict[str, list[Part]] = {}
    for part in parts:
        of_day.setdefault(part.value, []).append(part)
    days = []
    for of_value in of_day.values():
        size = sum(versions.stored_bytes(spark, root, p) for p in of_value)
        days.append(_documents(spark, root, of_value).coalesce(max(2, -(-size // FILE_BYTES))))
    return reduce(DataFrame.unionByName, days)


def compact_documents(spark: SparkSession, root: str, below: int) -> None:
    """Merge the documents of batches below ``below`` (above 0, all of them ended) by day, and their keys.

    The merged rows have the negative of ``below`` as their batch. Where retention has taken a folder away meanwhile, the
    work begins again from what it left; folders that are added meanwhile stay as they are.
    """
    while True:
        now = versions.read_version(spark, root)
        old = [p for p in now.of(DOCUMENTS) if p.batch < below]
        try:
            if len({p.folder.split("/")[1] for p in old}) > 1:
                rows = _days_merged(spark, root, old).withColumn("batch_id", F.lit(-below).cast("bigint"))
                merged = versions.write_parts(rows, root, DOCUMENTS, cut="created_date", batches="batch_id")
                versions.commit(spark, root, versions.replacing(old, merged))
            keyindex.compact_keys(spark, root, below)
            return
        except Conflict:
            continue


def first_batch(spark: SparkSession, root: str, checkpoint: str) -> int:
    """The number that the first batch of a stream has in the store: a stream with a new checkpoint goes on behind the
    batches that are there, one that was there before keeps its number."""
    name = f"first batch of {checkpoint}"

    def change(now: Version) -> tuple[list[Part], dict[str, str]]:
        own = str(1 + max((p.batch for p in now.parts), default=-1))
        return list(now.parts), now.settings if name in now.settings else now.settings | {name: max(own, "0", key=int)}

    known = versions.read_version(spark, root)
    if name not in known.settings:
        known = versions.commit(spark, root, change)
    return int(known.settings[name])


def write_counts(spark: SparkSession, root: str, batch_id: int, seen: dict) -> None:
    """What was counted of a batch's messages, and how many documents of it are stored."""
    stored = read_batch(spark, root, batch_id).count()
    row = [(seen.get("messages") or 0, seen.get("rejected") or 0, seen.get("late") or 0, stored)]
    write_batch(spark.createDataFrame(row, SCHEMAS["counts"]), root, "counts", batch_id)


def is_whole(spark: SparkSession, folder: str) -> bool:
    """Whether a folder was written to its end."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def make_folder(spark: SparkSession, folder: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)


def move_folder(spark: SparkSession, folder: str, target: str) -> bool:
    """Move a folder to a place where there is none; false where there is no such folder."""
    place, to = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (folder, target))
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(to.getParent())
    return files.exists(place) and files.rename(place, to)


def append_graph(rows: DataFrame, root: str, batch_id: int) -> None:
    """Add the batch's vertices and edges."""
    for name, build in (("persons", graph.persons), ("tags", graph.tags)):
        write_batch(build(rows).dropDuplicates([VERTEX_KEYS[name]]), root, name, batch_id)
    write_batch(graph.whole_posts(rows), root, "posts", batch_id)
    for name, build in (("posted", graph.posted), ("tagged", graph.tagged)):
        write_batch(build(rows), root, name, batch_id)


def _each_vertex(stored: DataFrame, name: str) -> DataFrame:
    first = Window.partitionBy(VERTEX_KEYS[name]).orderBy("batch_id")
    return stored.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn", "batch_id")


def _each_edge(stored: DataFrame, name: str) -> DataFrame:
    edges = stored.drop("batch_id")
    return graph.merge_edges(edges.limit(0), edges, *EDGE_KEYS[name])


def read_vertices(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Every vertex once, as the first batch that has it made it."""
    return _each_vertex(read(spark, root, name), name)


def read_edges(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Every edge once, whatever the number of batches that made it."""
    return _each_edge(read(spark, root, name), name)


def _folders(spark: SparkSession, pattern: str):
    """The file system and the folders that match."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files, [found.getPath() for found in files.globStatus(place) or []]


def compact_graph(spark: SparkSession, root: str, below: int) -> None:
    """Merge the graph tables' batches below ``below`` (above 0, all of them ended) into one folder each.

    The merged folder has the negative of ``below`` as its batch. It is whole before the others go, and readers take
    vertices and edges once, so readers see the same before, between and after, and it can be run again at any time.
    """
    for name in (*VERTEX_KEYS, *EDGE_KEYS):
        merge = _each_vertex if name in VERTEX_KEYS else _each_edge
        files, folders = _folders(spark, f"{root}/{name}/batch_id=*")
        number = {folder: int(folder.getName().split("=", 1)[1]) for folder in folders}
        old = [folder for folder in folders if number[folder] < below and number[folder] != -below]
        if old:
            closed = stage(read(spark, root, name).filter(F.col("batch_id") < below), "compact")
            write_batch(merge(closed, name), root, name, -below)
            for folder in old:
                files.delete(folder, True)


def purge_documents(spark: SparkSession, root: str, cutoff: Column) -> None:
    """Retention on the stored documents: the folders of days before the cutoff's day go, those of that day are rewritten,
    and keys of documents that went are not known any more.

    Younger days and documents without a time are not touched. A stream may go on writing: a batch that lands meanwhile
    is looked at too before this ends. Files are left to ``vacuum``, so readers keep the version that they look at.
    """
    at = spark.range(1).select(F.to_date(cutoff).alias("day"), F.date_format(cutoff, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time")).first()
    seen: set[Part] = set()
    while True:
        now = versions.read_version(spark, root)
        dated = [p for p in now.of(DOCUMENTS) if p.value != NO_DAY]
        old = [p for p in dated if p.value < str(at.day)]
        of_day = [p for p in dated if p.value == str(at.day) and p not in seen]
        if not old and not of_day and now.settings.get("cutoff", "") >= at.time:
            return
        kept = versions.write_parts(
            retain(_documents(spark, root, of_day), cutoff), root, DOCUMENTS, cut="created_date", batches="batch_id") if of_day else []
        try:
            latest = max(at.time, now.settings.get("cutoff", ""))
            versions.commit(spark, root, versions.replacing([*old, *of_day], kept, cutoff=latest))
        except Conflict:
            continue
        seen.update(kept)


def vacuum(spark: SparkSession, root: str, versions_kept: int = 10, older_ms: int = 24 * 3600 * 1000) -> None:
    """Delete the files that none of the last versions names."""
    versions.vacuum(spark, root, INDEXED, versions_kept, older_ms)


def append_scores(scores: DataFrame, root: str, run: int) -> None:
    """Store the bot scores of a run. Documents and persons get them when they are read, so none is rewritten."""
    write_batch(scores.select("user_id", *SCORE_FIELDS), root, "scores", run)


def read_scores(spark: SparkSession, root: str) -> DataFrame:
    """The newest score of each user."""
    last = Window.partitionBy("user_id").orderBy(F.desc("batch_id"))
    return read(spark, root, "scores").withColumn("_rn", F.row_number().over(last)).filter("_rn = 1").drop("_rn", "batch_id")


def scored_documents(spark: SparkSession, root: str) -> DataFrame:
    return write_back_scores(read(spark, root, "documents"), read_scores(spark, root))


def scored_persons(spark: SparkSession, root: str) -> DataFrame:
    return graph.score_persons(read_vertices(spark, root, "persons"), read_scores(spark, root))


def save_table(df: DataFrame, table: str, *partitions: str) -> None:
    df.write.mode("overwrite").partitionBy(*partitions).format("parquet").saveAsTable(table)


def purge_table(spark: SparkSession, table: str, cutoff: Column, created: str = "created_at") -> None:
    """Retention on a catalog table partitioned by ``created_date``.

    Days before the cutoff's day are dropped as partitions; only the cutoff's own day is
    rewritten, from a scratch copy. Younger days and rows without a time are not touched.
    """
    day = spark.range(1).select(F.to_date(cutoff).alias("day")).first().day
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        value = row.partition.split("=", 1)[1]
        if value != "__HIVE_DEFAULT_PARTITION__" and value < str(day):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (created_date = DATE'{value}')")
    on_the_day = spark.table(table).filter(F.col("created_date") == F.lit(day))
    kept = stage(retain(on_the_day, cutoff, created).drop("created_date"), "purge")
    partition = f"PARTITION (created_date = DATE'{day}')"
    if kept.isEmpty():
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {partition}")
    else:
        spark.sql(f"INSERT OVERWRITE TABLE {table} {partition} SELECT * FROM {{kept}}", kept=kept)
