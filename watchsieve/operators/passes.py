"""The passes that compare input records with the list, each a plan over distinct names.

records: record_id, source_id, external_id, contact_id, entity_id, entity_type, the raw columns, and their normalized forms
(sources.inputs.normalized). watch: the tables of sources.watchlist.WatchList."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import IntegerType, StructField, StructType

from ..config import ScreeningConfig
from ..functions.similarity import Many, hundredths, jw_bound, jw_percent
from ..functions.text import joined
from ..workers import find_library
from .blocking import alike, every_pair, org_pairs, person_pairs, spread
from .gates import ENTITY_JW, Streets, forms as forms_of, org_score, street_id, word_gate

RAW_ADDRESS = ("address1", "address2", "address3", "city", "region", "postal_code", "country")


def persons(records: DataFrame) -> DataFrame:
    return records.filter(F.coalesce(F.col("entity_type"), F.lit("")) != "Entity")


def orgs(records: DataFrame) -> DataFrame:
    return records.filter((F.coalesce(F.col("entity_type"), F.lit("")) != "Individual") & (F.col("entity_name_nm") != ""))


def _person(records: DataFrame, listed: DataFrame, config: ScreeningConfig) -> DataFrame:
    some = persons(records)
    pairs = person_pairs(some.select(F.col("first_name_nm").alias("fn"), F.col("last_name_nm").alias("ln")).distinct(), listed, config.person_jw, config.blocking)
    hits = pairs.join(listed, ["sdn_fn", "sdn_ln"])
    source = some.select("record_id", "first_name", "middle_name", "last_name", F.col("first_name_nm").alias("fn"), F.col("middle_name_nm").alias("mn"), F.col("last_name_nm").alias("ln"))
    return source.join(hits, ["fn", "ln"])


def person_primary(records: DataFrame, entries: DataFrame, config: ScreeningConfig) -> DataFrame:
    """Pass 1: persons against the primary names of listed individuals."""
    listed = entries.filter("lower(sdn_type) = 'individual'").select("uid", F.col("first_name").alias("raw_fn"), F.col("last_name").alias("raw_ln"), "sdn_type", F.col("first_name_nm").alias("sdn_fn"), F.col("last_name_nm").alias("sdn_ln"))
    return _person(records, listed, config).select(
        F.col("record_id").alias("Input_Record_ID"), F.col("first_name").alias("SourceFN"), F.col("middle_name").alias("SourceMN"), F.col("last_name").alias("SourceLN"),
        F.col("fn").alias("SourceFN_NM"), F.col("mn").alias("SourceMN_NM"), F.col("ln").alias("SourceLN_NM"), F.col("uid").alias("SDN_UID"), F.col("raw_fn").alias("SDNFN"), F.col("raw_ln").alias("SDNLN"),
        F.col("sdn_type").alias("SDN_Type"), F.lit("sdnEntry").alias("SDN_AKA_Source"), F.col("fn_jw").alias("FirstName_JaroWinklerSimilarity"), F.col("ln_jw").alias("LastName_JaroWinklerSimilarity"), F.lit(1).alias("Personal_Name_Match"),
    )


def person_aka(records: DataFrame, akas: DataFrame, config: ScreeningConfig) -> DataFrame:
    """Pass 2: persons against the other names of listed individuals."""
    listed = akas.filter("lower(sdn_type) = 'individual'").select("uid", "aka_uid", "category", F.col("first_name").alias("raw_fn"), F.col("last_name").alias("raw_ln"), F.col("first_name_nm").alias("sdn_fn"), F.col("last_name_nm").alias("sdn_ln"))
    return _person(records, listed, config).select(
        F.col("record_id").alias("Input_Record_ID"), F.col("uid").alias("SDN_UID"), F.col("aka_uid").alias("AKA_UID"), F.col("category").alias("AKA_Category"),
        F.col("first_name").alias("SourceFN"), F.col("middle_name").alias("SourceMN"), F.col("last_name").alias("SourceLN"), F.col("fn").alias("SourceFN_NM"), F.col("mn").alias("SourceMN_NM"), F.col("ln").alias("SourceLN_NM"),
        F.col("raw_fn").alias("SDNFN"), F.col("raw_ln").alias("SDNLN"), F.col("fn_jw").alias("FirstName_JaroWinklerSimilarity"), F.col("ln_jw").alias("LastName_JaroWinklerSimilarity"), F.lit(1).alias("Personal_Name_Match"),
    )


def _org(records: DataFrame, listed: DataFrame, config: ScreeningConfig, least: float) -> DataFrame:
    some = orgs(records)
    pairs = org_pairs(some.select(F.col("entity_name_nm").alias("nm")).distinct(), listed, config.blocking)
    pairs = pairs.repartition(int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # few bytes, which would be put in one task, but much to compare
    judged = pairs.withColumn("s", org_score("nm", "sdn_nm", least)).select("nm", "sdn_nm", "s.*").filter(F.col("passed") | word_gate(F.col("sdn_words"), F.col("matched")))
    return some.select("record_id", "entity_name", F.col("entity_name_nm").alias("nm")).join(judged.join(listed, "sdn_nm"), "nm")


def org_primary(records: DataFrame, entries: DataFrame, config: ScreeningConfig) -> tuple[DataFrame, DataFrame]:
    """Pass 3: organisations against listed entities; the matches, and what failed the gate with enough similar words."""
    listed = entries.filter("lower(sdn_type) = 'entity'").select("uid", F.col("last_name").alias("raw"), "sdn_type", F.col("org_name_nm").alias("sdn_nm"))
    rows = _org(records, listed, config, config.org_jw).select(
        F.col("record_id").alias("Input_Record_ID"), F.col("entity_name").alias("SourceOrgName"), F.col("nm").alias("SourceOrgName_NM"), F.col("uid").alias("SDN_UID"), F.col("raw").alias("SDNOrgName"), F.col("sdn_nm").alias("SDNOrgName_NM"),
        F.col("sdn_type").alias("SDN_Type"), F.lit("sdnEntry").alias("SDN_AKA_Source"), F.col("src_words").alias("SourceNumberofWords"), F.col("sdn_words").alias("SDNNumberofWords"),
        F.col("matched").alias("WordNumberMatchingJaroWinkler"), F.col("full_jw").alias("FullName_JaroWinklerSimilarity"), "passed",
    )
    return rows.filter("passed").drop("passed"), rows.filter("NOT passed").drop("passed")


def org_aka(records: DataFrame, akas: DataFrame, config: ScreeningConfig) -> tuple[DataFrame, DataFrame]:
    """Pass 3b: organisations against the other names of listed entities."""
    listed = akas.filter("lower(sdn_type) = 'entity'").select("uid", "aka_uid", "category", F.col("last_name").alias("raw"), "sdn_type", F.col("org_name_nm").alias("sdn_nm"))
    rows = _org(records, listed, config, config.org_jw).select(
        F.col("record_id").alias("Input_Record_ID"), F.col("uid").alias("SDN_UID"), F.col("aka_uid").alias("AKA_UID"), F.col("category").alias("AKA_Category"), F.col("entity_name").alias("SourceOrgName"), F.col("nm").alias("SourceOrgName_NM"),
        F.col("raw").alias("SDNOrgName"), F.col("sdn_nm").alias("SDNOrgName_NM"), F.col("sdn_type").alias("SDN_Type"), F.lit("akaList").alias("SDN_AKA_Source"), F.col("src_words").alias("SourceNumberofWords"),
        F.col("sdn_words").alias("SDNNumberofWords"), F.col("matched").alias("WordNumberMatchingJaroWinkler"), F.col("full_jw").alias("FullName_JaroWinklerSimilarity"), "passed",
    )
    return rows.filter("passed").drop("passed"), rows.filter("NOT passed").drop("passed")


def passing_pairs(records: DataFrame, entries: DataFrame, akas: DataFrame, config: ScreeningConfig) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What audit rows are made of, before any pair of records: given names (a) with their record_id; the pairs of names (a, b) of persons that match, and of organisations with enough similar words; and listed names (b) with their parties. As audit.passing_names of the four passes."""
    key = lambda kind, x, y, name: F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y")).alias(name)
    empty, null = F.lit(""), lambda kind: F.lit(None).cast(kind)
    some, theirs = persons(records), orgs(records)
    raw = ("uid", "sdn_type", "first_name", "last_name", "first_name_nm", "last_name_nm", "org_name_nm")
    names = entries.select(*raw, null("bigint").alias("aka_uid"), F.lit("Regular").alias("name_type")).union(akas.select(*raw, F.col("aka_uid").cast("bigint"), F.lit("AKA")))
    person, org = names.filter("lower(sdn_type) = 'individual'"), names.filter("lower(sdn_type) = 'entity'")
    close = person_pairs(some.select(F.col("first_name_nm").alias("fn"), F.col("last_name_nm").alias("ln")).distinct(), person.select(F.col("first_name_nm").alias("sdn_fn"), F.col("last_name_nm").alias("sdn_ln")), config.person_jw, config.blocking)
    judged = org_pairs(theirs.select(F.col("entity_name_nm").alias("nm")).distinct(), org.select(F.col("org_name_nm").alias("sdn_nm")), config.blocking)
    judged = judged.withColumn("s", org_score("nm", "sdn_nm", config.org_jw)).select("nm", "sdn_nm", "s.*").filter(word_gate(F.col("sdn_words"), F.col("matched")))
    pairs = close.select(key("P", F.col("fn"), F.col("ln"), "a"), key("P", F.col("sdn_fn"), F.col("sdn_ln"), "b"), F.col("fn_jw").alias("FN_JW"), F.col("ln_jw").alias("LN_JW"), null("double").alias("OrgNM_JW"), *[null("int").alias(n) for n in ("SourceNumberofWords", "SDNNumberofWords", "WordNumberMatchingJaroWinkler")])
    pairs = pairs.union(judged.select(key("O", F.col("nm"), empty, "a"), key("O", F.col("sdn_nm"), empty, "b"), null("double"), null("double"), "full_jw", "src_words", "sdn_words", "matched"))
    given = some.select("record_id", key("P", F.col("first_name_nm"), F.col("last_name_nm"), "a")).union(theirs.select("record_id", key("O", F.col("entity_name_nm"), empty, "a")))
    row = lambda fn: [F.col("uid").alias("SDN_UID"), F.col("aka_uid").alias("SDN_AKA_UID"), F.col("name_type").alias("SDN_Name_Type"), fn.alias("SDNCompareFN"), F.col("last_name").alias("SDNCompareLN")]
    listed = person.select(key("P", F.col("first_name_nm"), F.col("last_name_nm"), "b"), *row(F.col("first_name"))).union(org.select(key("O", F.col("org_name_nm"), empty, "b"), *row(null("string"))))
    return given, pairs, listed


def linked_to(records: DataFrame, remarks: DataFrame, config: ScreeningConfig) -> DataFrame:
    """Pass 5: names in "Linked to" remarks. remarks: uid, occurrence, text, text_nm, text_expanded."""
    form = lambda kind, *order: F.struct(F.lit(kind).alias("form"), joined(*order).alias("raw"), joined(*[f"{c}_nm" for c in order]).alias("nm"))
    forms = persons(records).select("record_id", F.inline(F.array(form("FN_MN_LN", "first_name", "middle_name", "last_name"), form("LN_FN_MN", "last_name", "first_name", "middle_name")))).filter("nm <> ''")
    low, theirs = forms.select("nm", F.lower("nm").alias("a")).distinct(), remarks.select("text_nm", F.lower("text_nm").alias("b")).distinct()
    close = alike(low.select("a").distinct(), theirs.select("b").distinct(), config.linked_person_jw - 1e-4, "full_jw").withColumn("full_jw", F.round(F.col("full_jw") * 100, 2)).filter(F.col("full_jw") >= config.linked_person_jw * 100)
    pairs = low.join(close, "a").join(theirs, "b")
    by_person = pairs.withColumn("s", org_score("nm", "text_nm", config.org_jw)).select("nm", "text_nm", F.col("s.src_words"), F.col("s.sdn_words"), F.col("s.matched"), "full_jw")
    person = spread(forms, by_person, remarks.select("uid", "occurrence", "text", "text_nm", "text_expanded"), "nm", "text_nm")
    columns = ["Input_Record_ID", "SDN_UID", "LinkedTo_Occurrence", "LinkedTo_Text", "LinkedTo_Text_NM", "LinkedTo_Text_NM_Expanded", "SourceName", "SourceName_NM", "Input_Name_Form", "SourceNumberOfWords", "LinkedToNumberOfWords", "WordNumberMatchingJaroWinkler", "FullName_JaroWinklerSimilarity"]
    first = person.select("record_id", "uid", "occurrence", "text", "text_nm", "text_expanded", "raw", "nm", "form", "src_words", "sdn_words", "matched", "full_jw").toDF(*columns)
    entities = records.filter("entity_type = 'Entity' AND entity_name_nm <> ''")
    names = entities.select(F.col("entity_name_nm").alias("nm")).distinct()
    expanded = remarks.select("text_expanded").filter("text_expanded <> ''").distinct()
    # an organisation passes by a form that both names have, or by names that are similar as a whole
    whole = every_pair(names.withColumn("a", F.lower("nm")), expanded.withColumn("b", F.lower("text_expanded")), jw_bound("a", "b") >= ENTITY_JW / 100 - 1e-4).select("nm", "text_expanded")
    shared = lambda df, c: df.select(c, F.explode(forms_of(c)).alias("form"))
    candidates = shared(names, "nm").join(shared(expanded, "text_expanded"), "form").select("nm", "text_expanded").union(whole).distinct()
    by_org = candidates.withColumn("s", org_score("nm", "text_expanded", config.org_jw)).select("nm", "text_expanded", "s.*").filter("passed")
    org = entities.withColumn("nm", F.col("entity_name_nm")).join(by_org, "nm").join(remarks, "text_expanded")
    second = org.select("record_id", "uid", "occurrence", "text", "text_nm", "text_expanded", F.coalesce("entity_name", F.lit("")), "nm", F.lit("EntityName"), "src_words", "sdn_words", "matched", "full_jw").toDF(*columns)
    return first.unionByName(second)


def phone(records: DataFrame, phones: DataFrame) -> DataFrame:
    """Pass 6: the last seven digits find parties, all of whose phones are then compared. phones: uid, raw, digits."""
    some = records.filter("phone_nm <> ''").select("record_id", "phone", "phone_nm", F.right("phone_nm", F.lit(7)).alias("last7"))
    index = phones.filter("length(digits) >= 7").select(F.right("digits", F.lit(7)).alias("last7"), "uid").distinct()
    numbers = some.select("phone_nm", "last7").distinct().join(index, "last7").join(phones, "uid")
    judged = numbers.select(
        "phone_nm", "uid", "raw", "digits", F.expr("cast(phone_nm = digits AS int)").alias("exact"),
        F.expr("cast(length(phone_nm) >= 10 AND length(digits) >= 10 AND right(phone_nm, 10) = right(digits, 10) AS int)").alias("last10"), jw_percent("phone_nm", "digits").alias("jw"),
    )
    return some.join(judged, "phone_nm").select(
        F.col("record_id").alias("Input_Record_ID"), F.col("uid").alias("SDN_UID"), F.col("raw").alias("SDN_Phone_Raw"), F.col("digits").alias("SDN_Phone_Digits"), F.col("phone").alias("Input_Phone_Raw"),
        F.col("phone_nm").alias("Input_Phone_Digits"), F.col("exact").alias("Exact_Match"), F.col("last10").alias("Last10_Match"), F.col("jw").alias("JaroWinkler_Digits"),
    )


def no_match(records: DataFrame, *matches: DataFrame) -> DataFrame:
    """Pass 7: the records that no name, linked-party or phone pass found."""
    found = matches[0].select("Input_Record_ID")
    for m in matches[1:]:
        found = found.union(m.select("Input_Record_ID"))
    rest = records.join(found.distinct().withColumnRenamed("Input_Record_ID", "record_id"), "record_id", "left_anti")
    return rest.select(
        F.col("record_id").alias("Input_Record_ID"), F.col("first_name").alias("SourceFN"), F.col("middle_name").alias("SourceMN"), F.col("last_name").alias("SourceLN"),
        F.col("entity_name").alias("SourceEntityName"), F.col("external_id").alias("ExternalID"), F.lit("No match found in any pass").alias("Note"),
    )


_PLACES = ("city_nm", "region_nm", "postal_code_nm", "country_nm")
_FOUND = pa.schema([("at", pa.list_(pa.int32())), ("street", pa.list_(pa.int8())), *((f"{n}_jw", pa.list_(pa.int16())) for n in _PLACES)])


class _Values:
    """The similarities, in hundredths of a percent, of a value with each listed one, for as many values as take some MB."""

    def __init__(self, values: list[str]) -> None:
        self.which, known = pd.factorize(pd.Series(values, dtype=str))
        self.many, self.found = Many([v.encode() for v in known]), {}

    def similar(self, value: str) -> np.ndarray:
        if value not in self.found:
            if len(self.found) * len(self.many.b) > 4_000_000:
                self.found.clear()
            self.found[value] = hundredths(self.many.jw(value.encode()))
        return self.found[value].take(self.which)


def _admitted(listed: Broadcast, least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of given addresses, with the numbers of the listed ones that the rule admits, their street ids and four similarities; in several rows where these are many."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = listed.value
        theirs = {n: rows.column(n).to_pylist() for n in ("address1_nm", "address2_nm", "address3_nm", *_PLACES)}
        lines = [*zip(*([x or "" for x in theirs[n]] for n in ("address1_nm", "address2_nm", "address3_nm")), strict=True)]
        streets, kinds = pd.factorize(pd.Series(lines, dtype=object)) if lines else (np.zeros(0, np.int64), [])
        known, values = Streets([*kinds]), [_Values([x or "" for x in theirs[n]]) for n in _PLACES]
        before, of_kinds = None, np.zeros(0, np.int8)
        for b in batches:
            take: list[int] = []
            out: list[list[np.ndarray]] = [[] for _ in range(6)]
            size = 0
            for i, (mailing, *places) in enumerate(zip(*(b.column(c).to_pylist() for c in ("mailing", *_PLACES)), strict=True)):
                if not len(lines):
                    continue
                if mailing != before:  # equal ones come together
                    before, of_kinds = mailing, known.ids(mailing, least).astype(np.int8)
                street = of_kinds.take(streets)
                jw = [v.similar(x or "") for v, x in zip(values, places, strict=True)]
                some = np.flatnonzero((street != 32) | (np.maximum(np.maximum(jw[0], jw[2]), jw[3]) >= least * 10_000 - 1e-6))
                for k in range(0, len(some), 20_000):
                    part = some[k : k + 20_000]
                    take.append(i)
                    for into, value in zip(out, (part.astype(np.int32), street[part], *(x[part] for x in jw)), strict=True):
                        into.append(value)
                    size += len(part)
                    if size > 200_000:
                        yield _batch(b, take, out)
                        take, out, size = [], [[] for _ in range(6)], 0
            if take:
                yield _batch(b, take, out)

    return compare


def _batch(b: pa.RecordBatch, take: list[int], out: list[list[np.ndarray]]) -> pa.RecordBatch:
    ends = pa.array(np.cumsum([0, *map(len, out[0])]), pa.int32())
    made = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x), f.type.value_type)) for x, f in zip(out, _FOUND, strict=True)]
    given = b.take(pa.array(take))
    return pa.RecordBatch.from_arrays([*given.columns, *made], names=[*given.schema.names, *_FOUND.names])


_LISTED = tuple(f"{c}_nm" for c in RAW_ADDRESS)
#: Listed addresses that the driver holds, and a task compares with, at once.
ADDRESS_ROWS = 50_000


def _met(given: DataFrame, theirs: DataFrame, kind: StructType, config: ScreeningConfig) -> DataFrame:
    """Pairs of given addresses with the listed ones of a chunk."""
    spark = given.sparkSession
    table = theirs.toArrow().sort_by([("uid", "ascending"), ("addr_uid", "ascending")])  # ADDRESS_ROWS or so
    table = table.append_column("at", pa.array(np.arange(len(table), dtype=np.int32)))
    listed = spark.sparkContext.broadcast(table.select([f"sdn_{c}" for c in _LISTED]).rename_columns([*_LISTED]))
    back = F.broadcast(spark.createDataFrame(table, schema=StructType([*theirs.schema.fields, StructField("at", IntegerType())])))
    found = given.mapInArrow(_admitted(listed, config.address_jw), kind)
    flat = found.select(*given.columns, *_FOUND.names[1:], F.posexplode("at").alias("_i", "at"))
    value = lambda c: F.get(c, F.col("_i"))
    return flat.select(*given.columns, "at", value("street").cast("int").alias("street"), *[(value(f"{n}_jw") / F.lit(100.0)).alias(f"{n}_jw") for n in _PLACES]).join(back, "at").drop("at")


def _of_matched(some: DataFrame, theirs: DataFrame, matched: DataFrame, config: ScreeningConfig) -> DataFrame:
    """Pairs of given addresses with those of the parties that were matched with their record."""
    matched = matched.select(F.col("Input_Record_ID").alias("record_id"), F.col("SDN_UID").alias("uid")).distinct()
    pairs = matched.join(theirs, "uid").join(some, "record_id").withColumn("street", street_id("mailing", "sdn_address1_nm", "sdn_address2_nm", "sdn_address3_nm", config.address_jw))
    pairs = pairs.withColumns({f"{n}_jw": jw_percent(n, f"sdn_{n}") for n in _PLACES})
    least = config.address_jw * 100
    return pairs.filter((F.col("street") != 32) | (F.col("city_nm_jw") >= least) | (F.col("postal_code_nm_jw") >= least) | (F.col("country_nm_jw") >= least))


def address(records: DataFrame, addresses: DataFrame, matched: DataFrame, config: ScreeningConfig) -> DataFrame:
    """Pass 4: addresses of the records in matched (Input_Record_ID, SDN_UID) against listed ones. addresses: uid, addr_uid, raw and _nm columns.

    A pair is admitted by any of four likenesses that no key stands for, so each address meets each listed one: the listed
    ones go to every task in chunks of ADDRESS_ROWS. The pairs of a given address leave the task as arrays beside its columns
    and meet the columns of the listed ones by their number there, so that no row of a pair is ever moved. Records of one
    mailing address come together, and it is compared once. Restricted to matched parties, only their addresses are met, by key."""
    spark = records.sparkSession
    find_library(spark)
    some = records.join(matched.select(F.col("Input_Record_ID").alias("record_id")).distinct(), "record_id", "left_semi").withColumn("mailing", joined("address1_nm", "address2_nm", "address3_nm"))
    some = some.select("record_id", "external_id", *RAW_ADDRESS, *_LISTED, "mailing").filter("mailing <> '' OR city_nm <> '' OR region_nm <> '' OR postal_code_nm <> '' OR country_nm <> ''")
    theirs = addresses.select("uid", "addr_uid", *[F.col(c).alias(f"sdn_{c}") for c in _LISTED], *[F.col(c).alias(f"raw_{c}") for c in RAW_ADDRESS])
    if config.restrict_to_matched_party:
        out = _of_matched(some, theirs, matched, config)
    else:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        given = some.repartitionByRange(parts, "mailing", F.xxhash64("record_id")).sortWithinPartitions("mailing")
        kind = StructType([*given.schema.fields, *from_arrow_schema(_FOUND).fields])
        chunks, number = -(-max(1, addresses.count()) // ADDRESS_ROWS), F.xxhash64("uid")
        out = reduce(DataFrame.union, [_met(given, theirs.filter(F.pmod(number, F.lit(chunks)) == k) if chunks > 1 else theirs, kind, config) for k in range(chunks)])
    label = {"address1": "Address1", "address2": "Address2", "address3": "Address3", "city": "City", "region": "StateProvince", "postal_code": "PostalCode", "country": "Country"}
    return out.select(
        F.col("record_id").alias("Input_Record_ID"), F.col("uid").alias("SDNEntry_UID"), F.col("addr_uid").alias("SDNAddress_UID"), F.col("external_id").alias("Source_UID"),
        *[F.col(c).alias(f"Source{label[c]}") for c in RAW_ADDRESS], *[F.col(f"{c}_nm").alias(f"Source{label[c]}_NM") for c in RAW_ADDRESS],
        *[F.col(f"raw_{c}").alias(f"SDN{label[c]}") for c in RAW_ADDRESS], *[F.col(f"sdn_{c}_nm").alias(f"SDN{label[c]}_NM") for c in RAW_ADDRESS],
        F.col("street").alias("JaroWinklerMatchStreetAddress"), F.col("city_nm_jw").alias("City_JaroWinklerSimilarity"), F.col("region_nm_jw").alias("StateProvince_JaroWinklerSimilarity"),
        F.col("postal_code_nm_jw").alias("PostalCode_JaroWinklerSimilarity"), F.col("country_nm_jw").alias("Country_JaroWinklerSimilarity"),
    )


def address_parts(records: DataFrame, addresses: DataFrame, matched: DataFrame, config: ScreeningConfig) -> tuple[DataFrame, DataFrame]:
    """The rows of address() in two parts: those that are the only one of their record and party, which a step that takes the best of each need not group, and the others."""
    several = addresses.groupBy("uid").count().filter("count > 1").select("uid")
    again = records.groupBy("record_id").count().filter("count > 1").select("record_id")
    once, twice = (records.join(again, "record_id", how) for how in ("left_anti", "left_semi"))
    one, more = (addresses.join(several, "uid", how) for how in ("left_anti", "left_semi"))
    return address(once, one, matched, config), address(once, more, matched, config).union(address(twice, addresses, matched, config))
