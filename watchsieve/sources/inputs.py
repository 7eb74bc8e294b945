"""Records to be screened, from files and tables, in one shape."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from datetime import datetime
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import ScreeningConfig
from ..durable import held
from ..functions import tables, text
from ..functions.text import blank_to_null
from ..workers import find_library

CSV_COLUMNS = {"EntityType": "entity_type", "EntityName": "entity_name", "FirstName": "first_name", "MiddleName": "middle_name", "LastName": "last_name", "Address1": "address1", "Address2": "address2", "Address3": "address3", "City": "city", "Region": "region", "PostalCode": "postal_code", "Country": "country"}
RAW = [*CSV_COLUMNS.values(), "phone", "external_id", "contact_id", "entity_id"]


def _column(df: DataFrame, name: str):
    found = {c.lstrip("﻿").strip().lower(): c for c in df.columns}
    return blank_to_null(F.col(f"`{found[name.lower()]}`").cast("string")) if name.lower() in found else F.lit(None).cast("string")


def shaped(df: DataFrame) -> DataFrame:
    """Any frame with some of the columns EntityType, EntityName and so on; missing ones are null, others are left out."""
    return df.select(*[_column(df, a).alias(b) for a, b in CSV_COLUMNS.items()], *[_column(df, n).alias(n) for n in RAW[len(CSV_COLUMNS) :]])


def from_csv(spark: SparkSession, path: str) -> DataFrame:
    return shaped(spark.read.csv(path, header=True, multiLine=True, escape='"'))


def from_table(spark: SparkSession, name: str) -> DataFrame:
    return shaped(spark.table(name))


def from_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    return shaped(spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options).load())


def from_principals(df: DataFrame, prefix: str | None = None, top: int | None = None) -> DataFrame:
    """Distinct principals whose ENTITY_NAME begins with prefix; individuals if they have any part of a person's name."""
    names = ["ENTITY_NAME", "ENTITY_NUM", "ORG_NAME", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "ADDRESS1", "ADDRESS2", "ADDRESS3", "CITY", "STATE", "COUNTRY", "POSTAL_CODE"]
    some = df.select(*[_column(df, n).alias(n) for n in names]).distinct()
    if prefix:
        some = some.filter(F.upper("ENTITY_NAME").startswith(prefix.upper()))
    if top is not None:
        some = some.orderBy("ENTITY_NAME", "LAST_NAME", "FIRST_NAME").limit(top)
    person = F.coalesce("FIRST_NAME", "MIDDLE_NAME", "LAST_NAME").isNotNull()
    return some.select(
        F.when(person, F.lit("Individual")).otherwise(F.lit("Entity")).alias("entity_type"), F.coalesce("ENTITY_NAME", "ORG_NAME").alias("entity_name"), F.col("FIRST_NAME").alias("first_name"), F.col("MIDDLE_NAME").alias("middle_name"), F.col("LAST_NAME").alias("last_name"),
        F.col("ADDRESS1").alias("address1"), F.col("ADDRESS2").alias("address2"), F.col("ADDRESS3").alias("address3"), F.col("CITY").alias("city"), F.col("STATE").alias("region"), F.col("POSTAL_CODE").alias("postal_code"), F.col("COUNTRY").alias("country"),
        F.lit(None).cast("string").alias("phone"), F.col("ENTITY_NUM").alias("external_id"), F.lit(None).cast("string").alias("contact_id"), F.lit(None).cast("string").alias("entity_id"),
    )


def legacy_principals(df: DataFrame, prefix: str | None = None) -> DataFrame:
    """principal_id and names for operators.legacy."""
    rows = df.select(*[_column(df, n).alias(n.lower()) for n in ("First_Name", "Middle_Name", "Last_Name", "Org_Name", "entity_name")])
    if prefix:
        rows = rows.filter(F.upper("entity_name").startswith(prefix.upper()))
    rows = rows.select("first_name", "middle_name", "last_name", "org_name").distinct()
    return rows.withColumn("principal_id", F.xxhash64("first_name", "middle_name", "last_name", "org_name"))


def from_screening(df: DataFrame, start_row: int | None = None, top: int | None = None, strict_reference: bool = False) -> DataFrame:
    """Screening rows as records: one for the organisation and one for the person, where the row names them.

    strict_reference: an organisation that only ORG_NAME names keeps an empty name and is found by nothing."""
    some = df if start_row is None else df.filter(F.col("ScreeningInput_ID") >= start_row)
    if top is not None:
        some = some.orderBy("ScreeningInput_ID").limit(top)
    c = {n: _column(df, n) for n in ("ENTITY_NAME", "ORG_NAME", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "ADDRESS1", "ADDRESS2", "ADDRESS3", "CITY", "STATE", "POSTAL_CODE", "COUNTRY", "PHONE", "Contact_ID", "Entity_ID", "ScreeningInput_ID")}
    company, null = F.coalesce(c["ENTITY_NAME"], c["ORG_NAME"]), F.lit(None).cast("string")
    name = c["ENTITY_NAME"] if strict_reference else company
    org = F.struct(F.lit("Entity").alias("entity_type"), F.coalesce(c["Entity_ID"], c["ScreeningInput_ID"]).alias("external_id"), null.alias("first_name"), null.alias("middle_name"), null.alias("last_name"))
    person = F.struct(F.lit("Individual").alias("entity_type"), F.coalesce(c["Contact_ID"], c["ScreeningInput_ID"]).alias("external_id"), c["FIRST_NAME"].alias("first_name"), c["MIDDLE_NAME"].alias("middle_name"), c["LAST_NAME"].alias("last_name"))
    each = F.filter(F.array(F.when(company.isNotNull(), org), F.when(F.coalesce(c["FIRST_NAME"], c["MIDDLE_NAME"], c["LAST_NAME"]).isNotNull(), person)), lambda x: x.isNotNull())
    rows = some.select(
        F.col("ScreeningInput_ID").alias("source_id"), F.posexplode(each).alias("kind", "r"), name.alias("entity_name"), *[c[a].alias(b) for a, b in (("ADDRESS1", "address1"), ("ADDRESS2", "address2"), ("ADDRESS3", "address3"), ("CITY", "city"), ("STATE", "region"), ("POSTAL_CODE", "postal_code"), ("COUNTRY", "country"), ("PHONE", "phone"), ("Contact_ID", "contact_id"), ("Entity_ID", "entity_id"))]
    )
    return rows.select("source_id", "kind", "entity_name", "r.*", "address1", "address2", "address3", "city", "region", "postal_code", "country", "phone", "contact_id", "entity_id")


def numbered(records: DataFrame, *order: str) -> DataFrame:
    """record_id from 1 in the given order: numbers within ranges of the order, offset by what lies before, so no task orders all rows."""
    order = order or tuple(c for c in ("source_id", "kind", "external_id", "entity_name", "last_name", "first_name") if c in records.columns)
    parts = records.repartitionByRange(max(1, records.sparkSession.sparkContext.defaultParallelism), *order).withColumn("_p", F.spark_partition_id())
    parts = held(parts)  # sizes and numbers are of the same ranges
    sizes = parts.groupBy("_p").count()
    before = sizes.withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")  # a row a partition
    nth = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return parts.withColumn("_n", nth).join(F.broadcast(before), "_p").withColumn("record_id", (F.col("_n") + F.col("_before")).cast("bigint")).drop("_p", "_n", "_before")


def normalized(records: DataFrame, config: ScreeningConfig = ScreeningConfig(), abbreviations: Iterable[tuple[str, str, int]] = tuple(tables.ADDRESS_ABBREVIATIONS), types: Iterable[tuple[str, str, str]] = tuple(tables.ENTITY_TYPES)) -> DataFrame:  # noqa: B008
    """records with their normalized columns; raw columns that are missing are null."""
    for c in RAW:
        if c not in records.columns:
            records = records.withColumn(c, F.lit(None).cast("string"))
    keep, abbreviations, types = config.keep_chars, list(abbreviations), list(types)
    return records.select(
        "*", *[text.person_name(c, keep).alias(f"{c}_nm") for c in ("first_name", "middle_name", "last_name")], text.org_name("entity_name", types, keep).alias("entity_name_nm"), *[text.address(c, abbreviations, keep).alias(f"{c}_nm") for c in ("address1", "address2", "address3", "city")],
        text.state("region", keep).alias("region_nm"), text.normalize("postal_code", keep).alias("postal_code_nm"), text.country("country", keep).alias("country_nm"), text.digits("phone").alias("phone_nm"),
    )


_SHEET_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
SHEET_COLUMNS = "ABCDEFGHIJK"


def sheet_cells(data: bytes) -> Iterator[tuple]:
    """Row number and the columns A to K of the first sheet of a workbook, as text; a cell without a value is null."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        names = book.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{_SHEET_NS}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_SHEET_NS}si")]
        first = min((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.sub(r"\D", "", n)))
        with book.open(first) as sheet:
            for _, row in ElementTree.iterparse(sheet):
                if row.tag != f"{_SHEET_NS}row":
                    continue
                found: dict[str, str] = {}
                for c in row.iter(f"{_SHEET_NS}c"):
                    value, kind = c.find(f"{_SHEET_NS}v"), c.get("t")
                    text_ = "".join(t.text or "" for t in c.iter(f"{_SHEET_NS}t")) if kind == "inlineStr" else value.text if value is not None else None
                    found[re.sub(r"\d", "", c.get("r"))] = shared[int(text_)] if kind == "s" and text_ is not None else text_
                yield (int(row.get("r")), *(found.get(k) for k in SHEET_COLUMNS))
                row.clear()


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """The cell grid of a workbook that any of Spark's file systems reaches, for from_sheet(): row_number and the columns A to K."""
    find_library(spark)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column("content"):
                rows = list(sheet_cells(data.as_py()))
                for k in range(0, len(rows), 10_000):
                    columns = list(zip(*rows[k : k + 10_000], strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(x, pa.string()) for x in columns[1:])], names=["row_number", *SHEET_COLUMNS])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(cells, "row_number int, " + ", ".join(f"{k} string" for k in SHEET_COLUMNS))


SHEET_SENTINEL = "Contact: Contact ID"


def from_sheet(cells: DataFrame, uploaded: datetime | None = None) -> DataFrame:
    """Screening rows from the cell grid of a spreadsheet: row_number and the columns A, B, C and so on. The layout is known by cell A1."""
    report = cells.filter(F.col("row_number") == 1).select(F.col("A").eqNullSafe(SHEET_SENTINEL).alias("r")).first()
    return sheet_report(cells, uploaded) if report and report.r else sheet_register(cells)


def sheet_report(cells: DataFrame, uploaded: datetime | None = None) -> DataFrame:
    s = {k: blank_to_null(F.col(k).cast("string")) for k in "ABCDEGHIJK"}
    rows = cells.filter(F.col("row_number") >= 2).filter(F.coalesce(*[s[k] for k in "ABCDE"]).isNotNull())
    return rows.select(F.lit(uploaded).cast("timestamp").alias("Upload_Date"), *[s[k].alias(n) for k, n in zip("CDEGHIJKAB", ("ORG_NAME", "FIRST_NAME", "LAST_NAME", "ADDRESS1", "CITY", "STATE", "POSTAL_CODE", "COUNTRY", "Contact_ID", "Entity_ID"), strict=True)])


def sheet_register(cells: DataFrame) -> DataFrame:
    """Rows from 12 on: organisation, first and last name, and an address of one line whose end may name a country; B3 has the date."""
    stamp = F.to_timestamp(F.regexp_extract("B", r"As of (\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})", 1))
    as_of = cells.filter(F.col("row_number") == 3).filter(F.col("B").rlike(r"As of \d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}")).select(stamp.alias("d")).first()
    rows = cells.filter((F.col("row_number") >= 12) & (F.coalesce(F.nullif("B", F.lit("")), F.nullif("E", F.lit("")), F.nullif("F", F.lit(""))).isNotNull()))
    where, null = text.country_at_end("H"), F.lit(None).cast("string")
    return rows.select(
        F.lit(as_of.d if as_of else None).cast("timestamp").alias("Upload_Date"), blank_to_null("B").alias("ORG_NAME"), blank_to_null("E").alias("FIRST_NAME"), blank_to_null("F").alias("LAST_NAME"), where["street"].alias("ADDRESS1"),
        *[null.alias(n) for n in ("CITY", "STATE", "POSTAL_CODE")], where["country"].alias("COUNTRY"), null.alias("Contact_ID"), null.alias("Entity_ID"),
    )


def latest_file(spark: SparkSession, folder: str, pattern: str = "*") -> str | None:
    """The file whose name has the latest time stamp of the form YYYY-MM-DD or YYYYMMDD with more digits after it."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    stamp = F.regexp_replace(F.regexp_extract("path", r"(\d{4}-?\d{2}-?\d{2}[-_T ]?\d*)[^/]*$", 1), r"\D", "")
    got = files.withColumn("s", F.rpad(stamp, 14, "0")).agg(F.max_by("path", F.struct("s", "path"))).first()
    return got[0] if got else None
