"""Line-delimited JSON in and out, id lists, and tables checked on reading."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.functions.hashing import stable_hash


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(raw) the lines of a file that aren't blank, each a JSON object; raises with file and text of one that isn't."""
    lines = spark.read.text(path).select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    bad = lines.where(F.try_parse_json("raw").isNull() | (F.substring(F.ltrim("raw"), 1, 1) != "{")).limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0]['file']}: not a JSON object: {bad[0]['raw'][:80]}")
    return lines.select("raw")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON objects, one a line; blank lines are skipped. Raises with file and line text where a line is no object."""
    return read_lines(spark, path).select(F.from_json("raw", schema, {"mode": "PERMISSIVE"}).alias("row")).select("row.*")


def as_json(df: DataFrame) -> Column:
    """Each row as JSON with sorted keys, without nulls."""
    return F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "true"})


def write_jsonl(df: DataFrame, path: str, files: int | None = None) -> None:
    """Rows as JSON lines with sorted keys, non-ASCII kept; files: how many files, for small tables."""
    lines = df.select(as_json(df).alias("value"))
    (lines.coalesce(files) if files else lines).write.mode("overwrite").text(path)


def read_id_list(spark: SparkSession, path: str | None) -> DataFrame:
    """(id) of a list file: trimmed, without blanks and comments; a missing file is an empty list."""
    empty = spark.createDataFrame([], "id string")
    if not path:
        return empty
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        return empty
    return lines.select(F.trim("value").alias("id")).where("id != '' and not startswith(id, '#')").distinct()


def read_json_list(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON file that holds a list of objects."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """Prompts with id, title and prompt, none of them empty, ids unique."""
    from sparkloom.operators.evaluation import require_unique

    rows = read_json_list(spark, path, "id string, title string, prompt string")
    if not rows.where("coalesce(trim(id), '') = '' or coalesce(trim(title), '') = '' or coalesce(trim(prompt), '') = ''").isEmpty():
        raise ValueError("a prompt lacks its id, title or text")
    require_unique(rows, "id")
    return rows


def shuffled(df: DataFrame, seed: int, key: str) -> DataFrame:
    """Rows in an order that seed and key fix, whatever the partitions."""
    return df.orderBy(stable_hash(F.lit(seed), F.col(key)))


def union_active(sources: dict[str, tuple[str, DataFrame]], weights: dict[str, float]) -> DataFrame:
    """Sources (name: category and rows) of categories with a weight, in one table; the others are never read."""
    own = [df.withColumn("source", F.lit(name)) for name, (category, df) in sources.items() if weights.get(category, 0) > 0]
    if not own:
        raise ValueError("no active source")
    out = own[0]
    for df in own[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(name, sha256, bytes) of files."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.substring_index("path", "/", -1).alias("name"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


#: What a training row holds; the last are left out where null.
ALWAYS = ("id", "group_id", "category", "reasoning_band", "num_tokens", "messages")
SOMETIMES = ("source", "source_id", "source_config", "source_split", "source_revision", "license", "verified", "curated", "verification_level", "verification_evidence", "template_id", "source_sha256", "revision_sha256")


def training_rows(df: DataFrame) -> DataFrame:
    """The output columns of candidates; tests and fingerprints stay behind."""
    return df.select(*[c for c in (*ALWAYS, *SOMETIMES) if c in df.columns])


def readable(report: dict) -> str:
    return json.dumps(report, ensure_ascii=False, indent=2, sort_keys=True, default=str) + "\n"


def write_report(report: dict, path: str) -> None:
    """A small report as readable JSON on the driver's side."""
    with open(path, "w", encoding="utf-8") as f:
        f.write(readable(report))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text as one file of any file system that Spark writes."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def resolve_revision(spark: SparkSession, root: str, name: str, revision: str) -> str:
    """What a revision stands for: the line of the source's refs file of that name, or itself where there is none."""
    try:
        found = spark.read.text(f"{root}/{name}/refs/{revision}").first()
    except AnalysisException:
        return revision
    return found["value"].strip() if found else revision


def with_row_index(df: DataFrame) -> DataFrame:
    """df with row_index, the row's number in the order in which it is read; no row is moved.

    Rows are numbered within their partition; the partitions' sizes, one row each, are added up and joined.
    """
    place = F.monotonically_increasing_id()
    own = df.withColumn("_part", F.shiftright(place, 33)).withColumn("_at", place.bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = own.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col("_part").alias("_p"), before.alias("_before"))
    return own.join(F.broadcast(sizes), F.col("_part") == F.col("_p")).select(*df.columns, (F.col("_before") + F.col("_at")).alias("row_index"))


def read_source(spark: SparkSession, root: str, source: dict, rows: int | None = None) -> DataFrame:
    """(raw, row_index, requested_revision, resolved_revision) of a source at its pinned revision, its first rows only if asked.

    source: name, revision and either file (JSON lines, each checked to be an object) or split and config_name (a
    Parquet folder, its rows as JSON). All lies below root/name@revision. A limit is a feature of collection.
    """
    asked = source.get("revision", "main")
    found = resolve_revision(spark, root, source["name"], asked)
    base = f"{root}/{source['name']}@{found}"
    if source.get("file"):
        raw = read_lines(spark, f"{base}/{source['file']}")
    else:
        table = spark.read.parquet(f"{base}/{source.get('config_name', 'default')}/{source.get('split', 'train')}")
        raw = table.select(F.to_json(F.struct("*")).alias("raw"))
    own = with_row_index(raw)
    own = own if rows is None else own.where(F.col("row_index") < rows)
    return own.withColumn("requested_revision", F.lit(asked)).withColumn("resolved_revision", F.lit(found))


def known_categories(candidates: DataFrame, categories: list[str], strict: bool = False) -> tuple[DataFrame, int]:
    """Candidates of known categories, and how many others there were; strict: one of those is an error."""
    known = F.coalesce(F.col("category").isin(*categories), F.lit(False))
    lost = candidates.where(~known).count()
    if lost and strict:
        raise ValueError(f"{lost} candidates of unknown categories")
    return candidates.where(known), lost


#: Prompts of the regression set.
REGRESSION_PROMPTS = 13


def read_regression(spark: SparkSession, path: str, count: int = REGRESSION_PROMPTS) -> DataFrame:
    """The regression set (id, template_id, title, prompt); raises unless it has all its prompts."""
    rows = read_prompts(spark, path)
    if (found := rows.count()) != count:
        raise ValueError(f"{found} regression prompts, expected {count}")
    return rows.select("id", F.concat(F.lit("regression/"), "id").alias("template_id"), "title", "prompt")
