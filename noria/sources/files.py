"""Readers and writers of the pipeline's tables."""

from __future__ import annotations

import io
import json
import re
import zipfile
from datetime import datetime
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noria.operators.corpus import union_by_name
from noria.session import ship_package
from noria.sources import storage, xls
from noria.store import Store

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def read_xlsx(content: bytes) -> pd.DataFrame:
    """The first sheet as strings; its first row names the columns."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
        first = ElementTree.fromstring(z.read("xl/workbook.xml")).find("m:sheets/m:sheet", _NS).get(_REL)
        target = next(r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels")) if r.get("Id") == first)
        sheet = ElementTree.fromstring(z.read(target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    rows = []
    for row in sheet.findall("m:sheetData/m:row", _NS):
        cells = {}
        for i, c in enumerate(row.findall("m:c", _NS)):
            at = _column(c.get("r")) if c.get("r") else i
            v = c.find("m:v", _NS)
            text = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t")) if c.get("t") == "inlineStr" else v.text if v is not None else None
            cells[at] = shared[int(text)] if c.get("t") == "s" and text is not None else text
        rows.append(cells)
    return _framed(rows)


def read_workbook(content: bytes) -> pd.DataFrame:
    """The first sheet of a workbook of either kind, which its first bytes tell."""
    return _framed(xls.rows(content)) if content[:8] == xls.MAGIC else read_xlsx(content)


def _framed(rows: list[dict]) -> pd.DataFrame:
    """Rows (column -> text) as strings; the first row names the columns."""
    if not rows:
        return pd.DataFrame()
    width = max(rows[0], default=-1) + 1
    header = [rows[0].get(i) or f"...{i + 1}" for i in range(width)]
    return pd.DataFrame([[r.get(i) for i in range(width)] for r in rows[1:]], columns=header, dtype=object)


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def write_xlsx(rows: list[list], path: str) -> None:
    """A workbook of one sheet of inline strings (small tables)."""
    cell = lambda v: "<c t='inlineStr'><is><t>" + str(v).replace("&", "&amp;").replace("<", "&lt;") + "</t></is></c>" if v is not None else "<c/>"
    body = "".join("<row>" + "".join(map(cell, r)) + "</row>" for r in rows)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook xmlns='{_NS['m']}' xmlns:r='http://schemas.openxmlformats.org/officeDocument/2006/relationships'><sheets><sheet name='a' sheetId='1' r:id='r1'/></sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships xmlns='http://schemas.openxmlformats.org/package/2006/relationships'><Relationship Id='r1' Target='worksheets/sheet1.xml'/></Relationships>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet xmlns='{_NS['m']}'><sheetData>{body}</sheetData></worksheet>")


def list_exports(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, modificationTime) of the Excel files, without their content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.xls*").option("recursiveFileLookup", "true").load(folder).select("path", "length", "modificationTime")


def read_exports(spark: SparkSession, folder: str) -> DataFrame:
    """All workbooks of a folder, .xlsx and .xls, united by column names, with source_file.

    A workbook is one value of a task.  The rows are written once, as JSON, in the shared
    folder; the columns' names are those of all files.
    """

    def rows(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                t = read_workbook(content)
                records = [json.dumps({k: v for k, v in r.items() if v is not None}, ensure_ascii=False) for r in t.to_dict("records")]
                yield pd.DataFrame({"source_file": path.rsplit("/", 1)[-1], "names": [list(map(str, t.columns))] * len(records), "record": records})

    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xls*").load(folder).select("path", "content")
    read = Store(spark).keep(files.mapInPandas(rows, "source_file string, names array<string>, record string"), "exports")
    names = [r[0] for r in read.select("source_file", F.explode("names").alias("n")).groupBy("n").agg(F.min("source_file").alias("f")).orderBy("f", "n").select("n").collect()]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return read.select(F.from_json("record", schema).alias("r"), "source_file").select("r.*", "source_file")


def read_many(spark: SparkSession, paths: list[str]) -> DataFrame:
    """CSV, JSON or Parquet files united by name, with source_file."""
    def one(p: str) -> DataFrame:
        kind = p.rsplit(".", 1)[-1].lower()
        df = spark.read.csv(p, header=True) if kind == "csv" else spark.read.json(p) if kind in ("json", "jsonl") else spark.read.parquet(p)
        return df.withColumn("source_file", F.lit(p.rsplit("/", 1)[-1]))

    return union_by_name([one(p) for p in paths])


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema, encoding="UTF-8", multiLine=True, escape='"')


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """(word, tag, freq) from a CSV whose word column is ngram, word or noun."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    word = next((c for c in ("ngram", "word", "noun") if c in df.columns), None)
    if word is None:
        raise ValueError("a column ngram, word or noun is needed")
    tag = next((c for c in ("pos_tag", "pos", "tag") if c in df.columns), None)
    freq = next((c for c in ("frequency", "freq") if c in df.columns), None)
    default = "NNG" if word == "ngram" else "NNP"
    named = F.coalesce(F.when(F.col(tag) != "", F.col(tag)), F.lit(default)) if tag else F.lit(default)
    return df.where(F.col(word).isNotNull() & (F.col(word) != "")).select(F.col(word).alias("word"), named.alias("tag"), (F.col(freq).try_cast("long") if freq else F.lit(None).cast("long")).alias("freq"))


#: Fixed field names of the recommendation files.
WORD, FREQ, REASON, CONTEXT, AREA, CONCEPT, TREND = "추천명사", "빈도수", "추천근거", "맥락적_용례", "주제_영역", "개념적_핵심성", "시계열적_동향"


def recommendations(spark: SparkSession, path: str) -> DataFrame:
    """(word, freq, context, type, concept, trend, source_file, folder, problem, raw): every record of the files, and every file that does not parse.

    The reason may be an object or a list of one, the context a text or a list.  problem is
    null for a good record, else 'file', 'word' (none) or 'frequency' (no number); raw is
    what a person needs to mend it.
    """
    schema = f"`{WORD}` string, `{FREQ}` string, `{REASON}` string, _corrupt_record string"
    read = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path).select("*", F.col("_metadata.file_name").alias("source_file"), F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder"))
    fields = f"struct<`{CONTEXT}`:string,`{AREA}`:string,`{CONCEPT}`:string,`{TREND}`:string>"
    reason = F.when(F.startswith(F.ltrim(REASON), F.lit("[")), F.from_json(REASON, f"array<{fields}>")[0]).otherwise(F.from_json(REASON, fields))
    first = lambda c: F.coalesce(F.when(F.startswith(F.ltrim(c), F.lit("[")), F.get(F.from_json(c, "array<string>"), F.lit(0))), c)
    freq = F.col(FREQ).try_cast("long")
    problem = F.when(F.col("_corrupt_record").isNotNull(), "file").when(F.coalesce(F.trim(WORD), F.lit("")) == "", "word").when(freq.isNull(), "frequency")
    raw = F.when(problem.isNotNull(), F.coalesce("_corrupt_record", F.to_json(F.struct(WORD, FREQ, REASON))))
    rows = read.withColumn("r", reason)
    return rows.select(F.col(WORD).alias("word"), freq.alias("freq"), first(F.col("r")[CONTEXT]).alias("context"), F.col("r")[AREA].alias("type"), F.col("r")[CONCEPT].alias("concept"), F.col("r")[TREND].alias("trend"), "source_file", "folder", problem.alias("problem"), raw.alias("raw"))


def read_recommendations(spark: SparkSession, path: str) -> DataFrame:
    """(word, freq, context, type, concept, trend, source_file): the good records of `recommendations`; those without a number stay, with a null."""
    return recommendations(spark, path).where("problem is null or problem = 'frequency'").drop("folder", "problem", "raw")


def quarantine(spark: SparkSession, path: str) -> DataFrame:
    """(folder, source_file, problem, raw): the files and records that a review leaves out."""
    return recommendations(spark, path).where("problem is not null").select("folder", "source_file", "problem", "raw")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(word, tag, score) of a tab-separated dictionary of two or three columns."""
    lines = spark.read.text(path).where("value not like '#%' and trim(value) <> ''").select(F.split("value", "\t").alias("f"))
    bad = lines.where(~F.size("f").isin(2, 3)).limit(1).collect()
    if bad:
        raise ValueError(f"2 or 3 columns are needed: {bad[0][0]}")
    return lines.select(F.col("f")[0].alias("word"), F.col("f")[1].alias("tag"), F.coalesce(F.get("f", F.lit(2)).try_cast("double"), F.lit(0.0)).alias("score"))


def read_dictionary_words(spark: SparkSession, path: str) -> DataFrame:
    """(word): first fields of the lines with a tab that are no comments."""
    return spark.read.text(path).where("value not like '#%' and value like '%\t%'").select(F.split("value", "\t")[0].alias("word"))


def write_dictionary(df: DataFrame, path: str) -> str:
    """One UTF-8 file of word, tag and score in the words' order, without header or quotes, on any file system; written by a task."""
    score = F.when(F.col("score") == F.floor("score"), F.col("score").cast("long").cast("string")).otherwise(F.col("score").cast("string"))
    line = F.concat_ws("\t", "word", "tag", F.coalesce(score, F.lit("0")))
    return storage.write_one(df.orderBy("word").select(line.alias("value")), path, "text")


#: Header of the proper nouns that are filled by hand.
PROPER_NOUNS = "noun string, pos_tag string"


def write_template(spark: SparkSession, path: str) -> str:
    """An empty CSV with the header of the proper nouns."""
    return storage.write_one(spark.createDataFrame([("noun", "pos_tag")], PROPER_NOUNS), path, "csv", header="false")


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    (df.coalesce(1) if one_file else df).write.option("header", True).option("encoding", "UTF-8").option("escape", '"').mode("errorifexists").csv(path)


def write_with_metadata(df: DataFrame, path: str, **metadata: str) -> None:
    """Parquet, and one row of metadata beside it."""
    df.write.mode("errorifexists").parquet(f"{path}/data")
    df.sparkSession.createDataFrame([{"written_at": datetime.now().isoformat(), **{k: str(v) for k, v in metadata.items()}}]).write.mode("errorifexists").json(f"{path}/metadata")


def stamped(prefix: str, suffix: str, ext: str, now: datetime | None = None) -> str:
    return f"{(now or datetime.now()):%Y%m%d_%H%M%S}_{prefix}{'_' + suffix if suffix else ''}.{ext}"
