"""Files in and out (S1-S17, S23): JSON with a top-level object or array, texts and pages, word files, result paths."""

from __future__ import annotations

import io
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanquarry.functions import text

LINK = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("file_type", "label", "title", "url")]))
_s = lambda *names: [T.StructField(n, T.StringType()) for n in names]
LEGAL_DOC = T.StructType([*_s("uid", "doc_id", "title", "doc_type", "issuing_body", "legal_field"), T.StructField("is_amendment", T.BooleanType()), *_s("signer", "issue_date", "effective_date", "status", "summary"), T.StructField("download_links", LINK), *_s("url", "raw_text")])
LEGAL_ARTICLE = T.StructType([*_s("article_id", "doc_id", "doc_uid", "article_uid", "article_number", "title", "content"), T.StructField("is_amendment", T.BooleanType())])
COURT_CASE = T.StructType(_s("uid", "url", "case_number", "court_name", "issuance_date", "title_web", "title_parsed", "legal_relation", "court_level", "case_type", "case_info", "legal_bases", "source_doc_url", "summary", "raw_text", "section_introduction", "section_content", "section_reasoning", "section_decision"))
ITEM = T.StructType([*_s("uid", "refer_uid", "refer_type", "refer_doc_id", "legal_field", "concept", "amendment_article_id", "question", "answer", "explanation"), T.StructField("options", T.ArrayType(T.StringType())), T.StructField("num_articles_found", T.IntegerType())])
RESPONSE = T.StructType([*ITEM.fields, *_s("task_id", "model", "model_answer", "raw_model_output", "evaluated_at"), T.StructField("latency_sec", T.DoubleType())])


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Rows of files that hold an object or an array of objects, with source_file; unreadable records, hence unreadable files, are left out."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    return rows.withColumn("source_file", F.col("_metadata.file_path")).filter("_corrupt_record is null").drop("_corrupt_record")


def write_json(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Rows as JSON lines; as one file only if asked for, since that takes one task."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").json(path)


def write_by_source(df: DataFrame, path: str, column: str = "source_file", sources: DataFrame | None = None) -> None:
    """One directory per input file, its name as the partition; those of the inputs in sources(column) without rows have one with an empty line only."""
    name = F.regexp_extract(F.col(column), r"([^/]+?)(?:\.[^./]*)?$", 1).alias("_source")
    rows = df.select(F.to_json(F.struct(*df.columns)).alias("value"), name)
    if sources is not None:
        rows = rows.unionByName(sources.select(F.lit("").alias("value"), name).distinct())  # readers pass over empty lines
    rows.write.mode("overwrite").partitionBy("_source").text(path)


def write_results(df: DataFrame, path: str) -> None:
    """Results by model and task."""
    df.withColumn("model_dir", text.model_dir(F.col("model"))).write.mode("overwrite").partitionBy("model_dir", "task_id").parquet(path)


def read_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, text) of whole text files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def pages(c: Column) -> Column:
    """Pages of a text, between two blank lines; stripped, empty ones left out."""
    return F.filter(F.transform(F.split(c, "\n\n\n"), text.strip), lambda x: x != "")


def is_scanned(page_texts: Column, first: int = 5, least: int = 50) -> Column:
    """Few characters on the first pages, or no page."""
    some = F.slice(page_texts, 1, first)
    total = F.aggregate(F.transform(some, lambda x: F.char_length(text.strip(text._text(x)))), F.lit(0), lambda a, x: a + x)
    return (F.size(some) < 1) | (total < least * F.size(some))


def docx_paragraphs(data: bytes | None) -> str:
    """The paragraphs of a word file, '' if it can't be read."""
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            root = ElementTree.fromstring(z.read("word/document.xml"))
    except Exception:
        return ""
    return "\n".join("".join(t.text or "" for t in p.iter(f"{w}t")) for p in root.iter(f"{w}p"))


@F.pandas_udf(T.StringType())
def docx_text(s: pd.Series) -> pd.Series:
    return s.map(lambda b: docx_paragraphs(bytes(b)) if b is not None else "")


def _pdf_pages(native, ocr, b: bytes) -> tuple[list[str], bool]:
    """The pages of a PDF, and whether they were recognised from scans."""
    found = native(b)
    first = found[:5]
    if ocr and (not first or sum(len(p.strip()) for p in first) < 50 * len(first)):
        return ocr(b), True
    return found, False


def pdf_adapter(native, ocr=None):
    """A column function from file content to text, from the functions of whatever PDF library there is: native(bytes) -> list of pages, ocr(bytes) -> list of pages for scanned files. What can't be read is ''."""

    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        def one(b) -> str:
            try:
                found, scanned = _pdf_pages(native, ocr, bytes(b))
            except Exception:
                return ""
            return ("\n\n" if scanned else "\n").join(p for p in found if p.strip())

        return s.map(one, na_action="ignore")

    return run


def pdf_pages_adapter(native, ocr=None):
    """The same as an array of pages."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(s: pd.Series) -> pd.Series:
        def one(b) -> list[str]:
            try:
                return _pdf_pages(native, ocr, bytes(b))[0]
            except Exception:
                return []

        return s.map(one, na_action="ignore")

    return run


def read_pages(spark: SparkSession, path: str, pdf_pages=None) -> DataFrame:
    """(path, page_no, text) of a directory of .txt and, with an adapter, .pdf files, page by page; other types raise an error when they are reached."""
    rows = spark.read.format("binaryFile").load(path)
    kind = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    body = F.when(kind == "txt", pages(F.decode("content", "UTF-8")))
    body = body.when(kind == "pdf", pdf_pages("content")) if pdf_pages else body
    other = F.raise_error(F.concat(F.lit("unsupported file type: "), "path")).cast("array<string>")
    return rows.select("path", F.posexplode(body.otherwise(other)).alias("page_no", "text")).withColumn("page_no", F.col("page_no") + 1)


def read_documents(spark: SparkSession, path: str, pdf=None) -> DataFrame:
    """(path, text) of a directory of .txt, .docx and, with an adapter, .pdf files; other types raise an error when they are reached."""
    rows = spark.read.format("binaryFile").load(path)
    kind = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    body = F.when(kind == "txt", F.decode("content", "UTF-8")).when(kind == "docx", docx_text("content"))
    body = body.when(kind == "pdf", pdf("content")) if pdf else body
    return rows.select("path", body.otherwise(F.raise_error(F.concat(F.lit("unsupported file type: "), "path"))).alias("text"))
