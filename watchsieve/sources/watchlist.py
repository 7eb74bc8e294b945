"""The watch list: shredded from XML, or from its tables, and made ready for the passes."""

from __future__ import annotations

import urllib.request
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import ScreeningConfig
from ..functions import tables, text
from ..functions.text import blank_to_null

_ITEM = {
    "aka": "uid INT, type STRING, category STRING, firstName STRING, lastName STRING, title STRING",
    "address": "uid INT, address1 STRING, address2 STRING, address3 STRING, city STRING, stateOrProvince STRING, postalCode STRING, country STRING",
    "id": "uid INT, idType STRING, idNumber STRING, idCountry STRING, issueDate STRING, expirationDate STRING",
    "dateOfBirthItem": "uid INT, dateOfBirth STRING, mainEntry STRING",
    "placeOfBirthItem": "uid INT, placeOfBirth STRING, mainEntry STRING",
    "nationality": "uid INT, country STRING, mainEntry STRING",
    "citizenship": "uid INT, country STRING, mainEntry STRING",
}
LISTS = {"aka": "akaList", "address": "addressList", "id": "idList", "dateOfBirthItem": "dateOfBirthList", "placeOfBirthItem": "placeOfBirthList", "nationality": "nationalityList", "citizenship": "citizenshipList"}
SCHEMA = (
    "uid INT, firstName STRING, lastName STRING, title STRING, sdnType STRING, remarks STRING, programList STRUCT<program: ARRAY<STRING>>, "
    + ", ".join(f"{LISTS[k]} STRUCT<{k}: ARRAY<STRUCT<{', '.join(f'{n}: {t}' for n, t in (x.split() for x in v.split(', ')))}>>>" for k, v in _ITEM.items())
    + ", vesselInfo STRUCT<callSign: STRING, vesselType: STRING, vesselFlag: STRING, vesselOwner: STRING, tonnage: STRING, grossRegisteredTonnage: STRING>"
)


def _trimmed(c: str, kind: str) -> Column:
    return blank_to_null(c).alias(c) if kind == "STRING" else F.col(c)


def _bit(c: str) -> Column:
    value = F.lower(F.trim(F.col(c)))
    return F.when(F.col(c).isNull(), F.lit(None)).otherwise(value.isin("true", "1", "yes").cast("int"))


def download(spark: SparkSession, url: str, path: str, timeout: float = 60) -> int:
    """Copies a list from an address to a path that Spark's file systems reach; nothing is there until all of it is. Returns the bytes."""
    jvm = spark.sparkContext._jvm
    target, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}._part")
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out, size = files.create(part, True), 0
    try:
        with urllib.request.urlopen(url, timeout=timeout) as source:
            while block := source.read(1 << 20):
                out.write(block)
                size += len(block)
    except OSError:
        out.close()
        files.delete(part, False)
        raise
    out.close()
    files.delete(target, False)
    files.rename(part, target)
    return size


def read_xml(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of a list in XML: sdnEntry, one table for each child list and one that ties its rows to the entries, vessels, programs, and the publication."""
    raw = spark.read.format("xml").option("rowTag", "sdnEntry").option("ignoreNamespace", "true").schema(SCHEMA).load(path).filter("uid IS NOT NULL")
    out = {"sdnEntry": raw.select("uid", *[_trimmed(c, "STRING") for c in ("firstName", "lastName", "title", "sdnType", "remarks")])}
    for item, at in LISTS.items():
        fields = [x.split() for x in _ITEM[item].split(", ")]
        rows = raw.select(F.col("uid").alias("sdnEntry_uid"), F.explode(f"{at}.{item}").alias("x")).select("sdnEntry_uid", "x.*").filter("uid IS NOT NULL")
        values = [_bit(c).alias(c) if c == "mainEntry" else _trimmed(c, t) for c, t in fields]
        out[at] = rows.select(*values).dropDuplicates(["uid"])
        out[f"sdnEntry_{at}"] = rows.select("sdnEntry_uid", F.col("uid").alias(f"{at}_uid")).distinct()
    vessels = raw.filter("vesselInfo IS NOT NULL").select("uid", "vesselInfo.*").select(F.col("uid").alias("sdnEntry_uid"), *[_trimmed(c, "STRING") for c in ("callSign", "vesselType", "vesselFlag", "vesselOwner", "tonnage", "grossRegisteredTonnage")])
    out["vesselInfo"] = vessels.withColumn("uid", F.col("sdnEntry_uid"))  # an entry has one vessel at most, so its uid is the row's
    programs = raw.select(F.col("uid").alias("sdnEntry_uid"), F.posexplode("programList.program").alias("at", "program")).withColumn("program", blank_to_null("program")).filter("program IS NOT NULL")
    names = programs.select("program").distinct()
    out["programList"] = names.withColumn("uid", F.row_number().over(Window.orderBy("program")))  # some dozens of programs
    out["sdnEntry_programList"] = programs.join(out["programList"], "program").select("sdnEntry_uid", F.col("uid").alias("programList_uid")).distinct()
    head = spark.read.format("xml").option("rowTag", "publshInformation").option("ignoreNamespace", "true").schema("Publish_Date STRING, Record_Count INT").load(path)
    out["publication"] = head.select(F.to_date(F.expr("try_to_timestamp(Publish_Date, 'MM/dd/yyyy')")).alias("Publish_Date"), "Record_Count")
    return out


@dataclass
class WatchList:
    """entries: uid, sdn_type, names, remarks. akas: uid, aka_uid, category, sdn_type, names. addresses, remarks (linked parties), phones."""

    entries: DataFrame
    akas: DataFrame
    addresses: DataFrame
    remarks: DataFrame
    phones: DataFrame

    def names(self) -> DataFrame:
        """Every name: uid, aka_uid (null for the primary one), sdn_type, name, category."""
        whole = text.joined("first_name", "last_name")
        return self.entries.select("uid", F.lit(None).cast("int").alias("aka_uid"), "sdn_type", whole.alias("name"), F.lit(None).cast("string").alias("category")).union(self.akas.select("uid", "aka_uid", "sdn_type", whole, "category"))


def first_uids(entries: DataFrame, n: int | None) -> DataFrame:
    """The n smallest uids; all without n."""
    return entries if n is None else entries.join(entries.select("uid").orderBy("uid").limit(n), "uid", "left_semi")


def prepared(tables_: dict[str, DataFrame], config: ScreeningConfig = ScreeningConfig(), abbreviations: Iterable[tuple[str, str, int]] = tuple(tables.ADDRESS_ABBREVIATIONS), types: Iterable[tuple[str, str, str]] = tuple(tables.ENTITY_TYPES), limit: int | None = None) -> WatchList:  # noqa: B008
    keep, abbreviations, types = config.keep_chars, list(abbreviations), list(types)
    names = [text.person_name("first_name", keep).alias("first_name_nm"), text.person_name("last_name", keep).alias("last_name_nm"), text.org_name("last_name", types, keep).alias("org_name_nm")]
    entry = first_uids(tables_["sdnEntry"], limit)
    entries = entry.select("uid", F.col("sdnType").alias("sdn_type"), F.col("firstName").alias("first_name"), F.col("lastName").alias("last_name"), "remarks").select("*", *names)
    kind = entries.select("uid", "sdn_type")
    tie = tables_["sdnEntry_akaList"].select(F.col("sdnEntry_uid").alias("uid"), F.col("akaList_uid").alias("aka_uid"))
    aka = tables_["akaList"].select(F.col("uid").alias("aka_uid"), "category", F.col("firstName").alias("first_name"), F.col("lastName").alias("last_name"))
    akas = aka.join(tie, "aka_uid").join(kind, "uid").select("*", *names)
    where = tables_["sdnEntry_addressList"].select(F.col("sdnEntry_uid").alias("uid"), F.col("addressList_uid").alias("addr_uid"))
    lines = tables_["addressList"].select(F.col("uid").alias("addr_uid"), "address1", "address2", "address3", "city", F.col("stateOrProvince").alias("region"), F.col("postalCode").alias("postal_code"), "country")
    addresses = lines.join(where, "addr_uid").join(kind.select("uid"), "uid", "left_semi").select(
        "*", *[text.address(c, abbreviations, keep).alias(f"{c}_nm") for c in ("address1", "address2", "address3", "city")], text.state("region", keep).alias("region_nm"), text.normalize("postal_code", keep).alias("postal_code_nm"), text.country("country", keep).alias("country_nm")
    )
    return WatchList(entries, akas, addresses, *remarks(entries, config, types))


def remarks(entries: DataFrame, config: ScreeningConfig = ScreeningConfig(), types: Iterable[tuple[str, str, str]] = tuple(tables.ENTITY_TYPES)) -> tuple[DataFrame, DataFrame]:  # noqa: B008
    """Linked parties (uid, occurrence, text, text_nm, text_expanded) and phones (uid, raw, digits) of the remarks."""
    linked = entries.select("uid", F.posexplode(text.linked_to("remarks")).alias("at", "text")).select("uid", (F.col("at") + 1).alias("occurrence"), "text", text.person_name("text", config.keep_chars).alias("text_nm"), text.org_name("text", types, config.keep_chars).alias("text_expanded"))
    phones = entries.select("uid", F.explode(text.phones("remarks")).alias("raw")).withColumn("digits", text.digits("raw"))
    return linked, phones


def latest_publication(publications: DataFrame) -> tuple:
    """Publish_Date and Record_Count of the publication with the largest ID; nulls without one."""
    row = publications.orderBy(F.desc("ID")).select("Publish_Date", "Record_Count").first()
    return tuple(row) if row else (None, None)
