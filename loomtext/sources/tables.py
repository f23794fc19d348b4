"""Tables at rest: dictionaries, word lists, tokens, lookups and folio maps; and the sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loomtext.functions import georgian

TOKENS = "token_id string, surface string, norm string, text_id string, para_id string, node_idx int, is_tail int, char_start int, char_end int, initial_char string"
MATCHED = TOKENS + ", match_tier string, match_id string, match_lemma string, match_def_ka string, match_source string, confidence string, in_lexicon string"
DICTIONARY = "xml_id string, lemma string, definition string, source_id string, source_siglum string, cross_refs string"
FOLIOS = "folio string, facs string, sp int, tile_url string, thumb_url string, viewer_url string"
LOOKUP = (
    "key string, xml_id string, source string, lemma string, variants array<string>, def_ka string, examples array<string>, source_id string, source_siglum string, "
    "cross_refs array<string>, in_lexicon boolean, tsv_supplements array<struct<source_id:string,source_siglum:string,def_ka:string,cross_refs:array<string>>>"
)

#: Characters of the texts whose words share a bucket.
BUCKET_CHARS = 4_000_000


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema=schema, quote='"', escape='"', multiLine=False, encoding="UTF-8")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Dictionary rows of a tab-separated file with a header; an empty table if there is no file."""
    return _tsv(spark, path, DICTIONARY) if exists(spark, path) else spark.createDataFrame([], DICTIONARY)


def read_tokens(spark: SparkSession, path: str, matched: bool = False) -> DataFrame:
    """Token rows, or matched ones."""
    return _tsv(spark, path, MATCHED if matched else TOKENS).withColumn("is_tail", F.col("is_tail") == 1)


def word_list(lines: DataFrame, normalise=georgian.normalise) -> DataFrame:
    """(word): the words of a list (column value), a word a line, ``#`` starting comments, and their normalised forms."""
    word = lines.select(F.trim("value").alias("word")).filter((F.col("word") != "") & ~F.startswith(F.col("word"), F.lit("#")))
    return word.unionByName(word.select(normalise(F.col("word")).alias("word"))).distinct()


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """``word_list`` of a file; an empty table if there is none."""
    return word_list(spark.read.text(path)) if exists(spark, path) else spark.createDataFrame([], "word string")


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A lookup written by ``write_json``; a missing one is an error."""
    return spark.read.schema(LOOKUP).json(path)


def read_folio_map(spark: SparkSession, *paths: str) -> DataFrame:
    """The folio map at the first of ``paths`` that exists and can be read, else an empty one."""
    for path in paths:
        if exists(spark, path):
            return spark.read.schema(FOLIOS).option("mode", "DROPMALFORMED").json(path).filter("folio is not null")
    return spark.createDataFrame([], FOLIOS)


def read_carryover(spark: SparkSession, path: str) -> DataFrame:
    """(surface, id): the corpus-wide map of surfaces in a JSON file of one object; an empty table if there is no file."""
    if not exists(spark, path):
        return spark.createDataFrame([], "surface string, id string")
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", "map<string,string>")).alias("surface", "id"))


def with_files(texts: DataFrame, files: DataFrame, root: str = "", column: str = "file_path") -> DataFrame:
    """The catalogue rows whose file (``column``, below ``root``) is among the read ``files`` (path, doc, text), with doc and text.
    Rows without a path, and those whose file doesn't exist, drop out."""
    plain = lambda c: F.regexp_replace(F.regexp_replace(c, "^file:/+", "/"), "/+", "/")
    wanted = plain(F.concat(F.lit(root + "/" if root else ""), F.col(column)))
    given = files.select(plain(F.col("path")).alias("__path"), "doc", "text")
    return texts.filter(F.coalesce(column, F.lit("")) != "").withColumn("__path", wanted).join(given, "__path").drop("__path")


def folio_map(spark: SparkSession, offset: int, total: int, service: str, viewer: str) -> DataFrame:
    """Folios 1r, 1v, 2r … in sequence after ``offset`` leading images, with their image addresses below ``service`` and ``viewer``."""
    sp = spark.range(offset + 1, total + 1).select(F.col("id").cast("int").alias("sp"))
    k = F.col("sp") - offset - 1
    sp = sp.withColumn("folio", F.concat((F.floor(k / 2) + 1).cast("string"), F.when(k % 2 == 0, "r").otherwise("v")))
    facs = F.concat(F.lit(service + ":"), F.format_string("%04d", "sp"))
    return sp.select(
        "folio", facs.alias("facs"), "sp", F.concat(facs, F.lit("/full/full/0/default.jpg")).alias("tile_url"),
        F.concat(facs, F.lit("/full/pct:12.5/0/default.jpg")).alias("thumb_url"), F.concat(F.lit(viewer + "?sp="), F.col("sp").cast("string")).alias("viewer_url"),
    )


# --- Sinks ----------------------------------------------------------------------------------------


def _flat(df: DataFrame) -> DataFrame:
    """Arrays as bar-joined strings, flags as 0/1, nulls as empty strings."""
    out: list[Column] = []
    for f in df.schema.fields:
        kind, c = f.dataType.simpleString(), F.col(f"`{f.name}`")
        c = F.array_join(c, "|") if kind == "array<string>" else c.cast("int").cast("string") if kind == "boolean" else c.cast("string")
        out.append(F.coalesce(c, F.lit("")).alias(f.name))
    return df.select(*out)


def write_tsv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Tab-separated files with a header; the readers find out how files are compressed by their names."""
    _flat(df).write.mode("overwrite").option("compression", compression).option("sep", "\t").option("header", True).option("escape", "\"").option("emptyValue", "").csv(path)


def write_split(df: DataFrame, path: str, column: str, values: dict[str, str]) -> None:
    """``df`` as a whole in ``all``, and the rows of each of ``values`` (folder -> value of ``column``) in a folder of their own."""
    write_tsv(df, f"{path}/all")
    for folder, value in values.items():
        write_tsv(df.filter(F.col(column) == value), f"{path}/{folder}")


def split_sink(df: DataFrame, path: str, column: str, values: dict[str, str], compression: str = "none") -> DataFrame:
    """What ``write_split`` writes, in one pass over ``df``: rows go to folder ``all`` and, by ``column``, to those of ``values`` (folder -> value), as partitions of one
    write. Returns (folder, observed): the rows counted on the way, also for folders that stay empty."""
    seen = Observation()
    of = {"all": F.lit(True), **{folder: F.coalesce(F.col(column) == value, F.lit(False)) for folder, value in values.items()}}
    df = df.observe(seen, *[F.count_if(c).alias(folder) for folder, c in of.items()])
    folders = F.array_compact(F.array(*[F.when(c, F.lit(folder)) for folder, c in of.items()]))
    out = _flat(df.withColumn("__folders", folders)).withColumn("folder", F.explode(F.split("__folders", r"\|"))).drop("__folders")
    out.write.mode("overwrite").partitionBy("folder").option("compression", compression).option("sep", "\t").option("header", True).option("escape", "\"").option("emptyValue", "").csv(path)
    return df.sparkSession.createDataFrame(list(seen.get.items()), "folder string, observed long")


def read_split(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a ``split_sink`` with their folder; one folder is read by a filter on it."""
    return _tsv(spark, path, schema + ", folder string")


def replace_copy(spark: SparkSession, source: str, target: str) -> bool:
    """Copies a folder, in place of what was at ``target``; False, and nothing happens, if there is no ``source``."""
    if not exists(spark, source):
        return False
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    a, b = path(source), path(target)
    to = b.getFileSystem(conf)
    to.delete(b, True)
    return bool(spark._jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, to, b, False, conf))


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a line, characters as they are."""
    df.write.mode("overwrite").json(path)


def write_pages(pages: DataFrame, path: str) -> None:
    """(path, html) rows; a page per row, never in place."""
    pages.select("path", "html").write.mode("overwrite").parquet(path)


def write_documents(docs: DataFrame, path: str, version: str) -> None:
    """A new version of documents (doc, text) beside the old ones."""
    docs.select("doc", "text").write.mode("errorifexists").parquet(f"{path}/version={version}")


def publish(docs: DataFrame, path: str, version: str) -> None:
    """``write_documents`` that no reader sees half done: the version is written aside and appears by one rename. A version that exists
    already is an error, and nothing is left of the new one."""
    spark = docs.sparkSession
    target, aside = f"{path}/version={version}", f"{path}/_{version}-{uuid.uuid4().hex}"
    where, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    fs = where(target).getFileSystem(conf)
    docs.select("doc", "text").write.parquet(aside)
    if fs.exists(where(target)) or not fs.rename(where(aside), where(target)):
        fs.delete(where(aside), True)
        raise FileExistsError(target)


def read_version(spark: SparkSession, path: str, version: str) -> DataFrame:
    """(doc, text) of a published version."""
    return spark.read.schema("doc string, text string").parquet(f"{path}/version={version}")


# --- Stored tokens --------------------------------------------------------------------------------


def _bucket(text: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(text.cast("string")), F.lit(buckets)).cast("int")


def write_store(rows: DataFrame, path: str, text: str = "text_id", buckets: int = 64) -> None:
    """Rows of texts in ``buckets`` folders by text, sorted by it inside each file, so that a text's rows are read without the others'."""
    kept = rows.withColumn("bucket", _bucket(F.col(text), buckets))
    kept.repartition("bucket").sortWithinPartitions("bucket", text).write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_store(spark: SparkSession, path: str, schema: str, texts: list | None = None, text: str = "text_id", buckets: int = 64) -> DataFrame:
    """The rows of a store, of ``texts`` only where they are given: their folders are chosen before anything is read, their rows by file statistics."""
    rows = spark.read.schema(schema + ", bucket int").parquet(path)
    if texts is None:
        return rows.drop("bucket")
    known = spark.createDataFrame([(str(t),) for t in texts], "t string").select(_bucket(F.col("t"), buckets)).distinct() if texts else None
    folders = [r[0] for r in known.collect()] if known is not None else []  # one for each text at most
    return rows.filter(F.col("bucket").isin(folders) & F.col(text).isin(texts)).drop("bucket")


def buckets_for(texts: DataFrame, text: str = "text", chars: int = BUCKET_CHARS, least: int = 16) -> int:
    """As many buckets as leave about ``chars`` characters of ``texts`` to each, so that what a task sorts doesn't grow with the table."""
    return max(least, -(-(texts.agg(F.sum(F.char_length(text))).first()[0] or 0) // chars))


def bucketed(rows: DataFrame, path: str, key: str, buckets: int = 16) -> str:
    """Writes ``rows`` as a table bucketed and sorted by ``key`` and returns its name: tables of one number of buckets join by the key without a shuffle.
    The files go with the session; in a catalog that outlives it the caller drops the table."""
    name = f"loomtext_{uuid.uuid4().hex}"
    rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return name
