"""Scans of the text formats the analyses start from, and stage sinks.

Every reader takes an explicit schema (no inference pass over the data)
and returns a DataFrame; nothing is parsed on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                   header: bool = False) -> DataFrame:
    """A1: delimited text with a fixed schema.  Multi-character separators
    (``::``) and whitespace runs go through ``read.text`` + ``split``."""
    if sep in (",", "|", "\t", ";") and len(sep) == 1:
        return spark.read.csv(path, schema=schema, sep=sep, header=header, mode="PERMISSIVE")
    pattern = r"\s+" if sep == "whitespace" else sep.replace("|", r"\|").replace(":", ":")
    parts = F.split(F.trim(F.col("value")), pattern)
    # the CSV reader drops the first line of every file; a separator that no line holds keeps lines whole
    lines = spark.read.csv(path, schema="value string", sep="\u0001", quote="", header=True) if header else spark.read.text(path)
    return lines.select(*[parts[i].try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    """A2: lines 'node n1 n2 ...' to an edge list (src, dst)."""
    toks = F.split(F.trim(F.col("value")), r"\s+")
    return (spark.read.text(path)
            .select(toks[0].cast("long").alias("src"), F.slice(toks, F.lit(2), F.size(toks)).alias("_n"))
            .select("src", F.explode("_n").alias("_d"))
            .select("src", F.col("_d").cast("long").alias("dst")))


def read_quoted_names(spark: SparkSession, path: str) -> DataFrame:
    """A3: lines 'id "NAME"' to (id, name)."""
    line = F.col("value")
    return spark.read.text(path).select(
        F.regexp_extract(line, r"^\s*(\d+)", 1).cast("long").alias("id"),
        F.regexp_extract(line, r'"([^"]*)"', 1).alias("name"))


def read_csv_header(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A4: CSV with a header line; an explicit schema when known."""
    r = spark.read.option("header", True)
    return r.csv(path, schema=schema) if schema is not None else r.option("inferSchema", True).csv(path)


def read_matrix(spark: SparkSession, path: str, columns: dict[int, tuple[str, str]], sep: str = r"\s+") -> DataFrame:
    """A5: headerless numeric matrix; ``columns`` maps 0-based ordinals to
    (name, type)."""
    parts = F.split(F.trim(F.col("value")), sep)
    return spark.read.text(path).select(*[parts[i].try_cast(t).alias(n) for i, (n, t) in sorted(columns.items())])


def flatten_tree(spark: SparkSession, path: str, record_schema: str, date_pattern: str = r"^\d{4}-\d{2}-\d{2}") -> DataFrame:
    """JSON trees ``{user: {session: record}}`` or ``{user: record}`` (or
    mixed) to rows (user, session, record fields).  Keys are data, so the
    tree is read as maps; a second-level key that looks like a date is a
    session, anything else means the record sits directly under the user."""
    raw = spark.read.text(path, wholetext=False)
    top = F.from_json("value", "map<string,map<string,string>>")
    users = raw.select(F.explode(top).alias("user", "node"))
    inner = users.select("user", F.explode("node").alias("k", "v"))
    is_session = F.col("k").rlike(date_pattern)
    sess = inner.filter(is_session).select("user", F.col("k").alias("session"),
                                           F.from_json("v", record_schema).alias("r"))
    direct = (inner.filter(~is_session).groupBy("user")
              .agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("k", "v")))).alias("v"))
              .select("user", F.lit(None).cast("string").alias("session"), F.from_json("v", record_schema).alias("r")))
    return sess.unionByName(direct).select("user", "session", "r.*")


# Layout of a status record (post with optional embedded post).
_USER = "struct<screen_name: string, followers_count: long, location: string>"
_ENTITIES = "struct<hashtags: array<struct<text: string>>, user_mentions: array<struct<screen_name: string>>>"
STATUS_SCHEMA = (
    f"id long, created_at string, full_text string, favorite_count long, retweet_count long, user {_USER}, "
    f"entities {_ENTITIES}, retweeted_status struct<id: long, created_at: string, full_text: string, "
    f"favorite_count: long, retweet_count: long, user: {_USER}, entities: {_ENTITIES}>"
)


def status_rows(statuses: DataFrame) -> DataFrame:
    """Each status becomes one row; an embedded (re)posted status adds a
    row of its own, and the acting row keeps blank text and zero likes."""
    def row(s, acting: bool, parent=None):
        return F.struct(
            s["id"].alias("id"), s["user"]["screen_name"].alias("handle"),
            s["user"]["followers_count"].alias("init_reach"), s["created_at"].alias("timestamp"),
            (F.lit("") if acting else s["full_text"]).alias("text"),
            (F.lit(0).cast("long") if acting else s["favorite_count"]).alias("likes"),
            s["retweet_count"].alias("retweets"),
            F.array_join(F.transform(s["entities"]["hashtags"], lambda h: h["text"]), " ").alias("hashtags"),
            F.array_join(F.transform(s["entities"]["user_mentions"], lambda m: m["screen_name"]), " ").alias("mentions"),
            s["user"]["location"].alias("location"),
            (parent if parent is not None else F.lit(None).cast("long")).alias("retweeted"),
        )

    has_rt = F.col("retweeted_status").isNotNull()
    acting = F.when(has_rt, row(F.col("s"), True, F.col("retweeted_status.id"))).otherwise(row(F.col("s"), False))
    embedded = F.when(has_rt, row(F.col("retweeted_status"), False))
    base = statuses.select(F.struct(*[F.col(c) for c in ("id", "created_at", "full_text", "favorite_count",
                                                        "retweet_count", "user", "entities")]).alias("s"),
                           "retweeted_status")
    return base.select(F.explode(F.array_compact(F.array(acting, embedded))).alias("r")).select("r.*")


def parse_packed(df: DataFrame, c: str, fields: Sequence[tuple[str, str]], keep: Sequence[str] = (),
                 sep: str = ",") -> DataFrame:
    """Comma-packed records to typed columns; records with too few
    fields are skipped; bad numbers become null (``try_cast``)."""
    parts = F.split(F.col(c), sep)
    out = df.filter(F.size(parts) >= len(fields))
    return out.select(*keep, *[(parts[i] if t == "string" else parts[i].try_cast(t)).alias(n)
                               for i, (n, t) in enumerate(fields)])


def rows_to_view(spark: SparkSession, rows: list[tuple], schema: T.StructType, name: str) -> DataFrame:
    """Small in-memory rows -> DataFrame with an explicit schema -> temp view."""
    df = spark.createDataFrame(rows, schema=schema)
    df.createOrReplaceTempView(name)
    return df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    """CSV sink (overwrite or append)."""
    df.write.mode(mode).option("header", header).csv(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Binary table sink (parquet), optionally partitioned."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def stage(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Materialise-or-load.  When ``path`` holds a finished stage, read
    it; when there is nothing, build, write and read back (an unfinished one is an error), so later steps depend on the
    stored table (in shared storage), not on the lineage."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop(path, "_SUCCESS")):
        if fs.exists(hadoop(path)):
            raise FileExistsError(f"{path} holds no finished stage; it is left as it is")
        build().write.parquet(path)
    return spark.read.parquet(path)


def resume_grid(done: DataFrame, todo: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A13 (resume): the (parameter, fold) rows of a grid still to run."""
    return todo.join(done.select(*keys).distinct(), list(keys), "left_anti")
