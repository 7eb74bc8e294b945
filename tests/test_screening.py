import itertools

import pytest
from pyspark.sql import functions as F

from watchsieve.config import ScreeningConfig
from watchsieve.functions.metaphone import double_metaphone
from watchsieve.functions.similarity import jw_pairs, osa_many, osa_one, register
from watchsieve.operators import audit, blocking, dummy, legacy, passes, report, summary
from watchsieve.plans.screening import screen
from watchsieve.sinks import Store, export_csv, export_legacy, export_non_passing, export_run, run_log_text, write_back
from watchsieve.sources import inputs, lookups, watchlist
from watchsieve.streaming.screen import screen_stream

XML = """<?xml version="1.0"?>
<sdnList xmlns="http://example.org/list">
<publshInformation><Publish_Date>01/31/2024</Publish_Date><Record_Count>4</Record_Count></publshInformation>
<sdnEntry><uid>1</uid><firstName> Ivan </firstName><lastName>Petrov</lastName><sdnType>Individual</sdnType><remarks>Linked to: ACME TRADING LTD; Phone: +1 (202) 555-0101</remarks>
 <programList><program>A</program><program>B</program></programList>
 <akaList><aka><uid>11</uid><type>a.k.a.</type><category>strong</category><firstName>Iwan</firstName><lastName>Petroff</lastName></aka></akaList>
 <addressList><address><uid>21</uid><address1>12 Main St</address1><city>Moscow</city><country>Russia</country></address></addressList>
 <dateOfBirthList><dateOfBirthItem><uid>31</uid><dateOfBirth>1 Jan 1970</dateOfBirth><mainEntry>true</mainEntry></dateOfBirthItem></dateOfBirthList></sdnEntry>
<sdnEntry><uid>2</uid><lastName>Acme Trading LLC</lastName><sdnType>Entity</sdnType><programList><program>A</program></programList>
 <akaList><aka><uid>12</uid><category>weak</category><lastName>Acme Commerce LLC</lastName></aka></akaList></sdnEntry>
<sdnEntry><uid>3</uid><lastName>SEA STAR</lastName><sdnType>Vessel</sdnType><vesselInfo><callSign>XYZ</callSign><vesselType> </vesselType></vesselInfo></sdnEntry>
<sdnEntry><uid>4</uid><lastName>Mononym</lastName><sdnType>Individual</sdnType></sdnEntry>
<sdnEntry><lastName>Nobody</lastName></sdnEntry>
</sdnList>"""


@pytest.fixture(scope="module")
def xml(tmp_path_factory):
    path = tmp_path_factory.mktemp("list") / "list.xml"
    path.write_text(XML)
    return str(path)


@pytest.fixture(scope="module")
def watch(spark, xml):
    return watchlist.prepared(watchlist.read_xml(spark, xml))


@pytest.fixture(scope="module")
def given(spark):
    rows = [
        ("Individual", None, "Ivan", "Petrov", "12 Main Street", "Moscow", "RU", "1-202-555-0101", "x1"),
        ("Individual", None, "Iwan", "Petroff", None, None, None, None, "x2"),
        ("Entity", "ACME TRADING L.L.C.", None, None, None, "Moscow", "RU", None, "x3"),
        ("Entity", "Zebra Foods Inc", None, None, None, None, None, None, "x4"),
        ("Individual", None, None, "Mononym", None, None, None, None, "x5"),
        ("Entity", "Acme Trading Ltd", None, None, None, None, None, "555-0101", "x6"),
        (None, None, None, None, None, None, None, None, "x7"),
    ]
    df = spark.createDataFrame(rows, "entity_type string, entity_name string, first_name string, last_name string, address1 string, city string, country string, phone string, external_id string")
    return inputs.normalized(inputs.numbered(df, "external_id")).cache()


@pytest.fixture(scope="module")
def result(given, watch):
    return screen(given, watch)


def ids(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_xml(spark, xml):
    t = watchlist.read_xml(spark, xml)
    assert t["sdnEntry"].count() == 4
    assert t["sdnEntry"].filter("uid = 1").first().firstName == "Ivan"
    assert ids(t["sdnEntry_akaList"], "sdnEntry_uid", "akaList_uid") == [(1, 11), (2, 12)]
    assert t["dateOfBirthList"].first().mainEntry == 1
    assert t["vesselInfo"].first().vesselType is None
    assert ids(t["programList"], "program") == [("A",), ("B",)]
    assert t["sdnEntry_programList"].count() == 3
    p = t["publication"].first()
    assert (str(p.Publish_Date), p.Record_Count) == ("2024-01-31", 4)


def test_download(spark, tmp_path):
    import functools
    import http.server
    import threading

    (tmp_path / "list.xml").write_text(XML)
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), functools.partial(http.server.SimpleHTTPRequestHandler, directory=str(tmp_path)))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{server.server_port}"
    for _ in range(2):
        assert watchlist.download(spark, f"{at}/list.xml", str(tmp_path / "got.xml")) == len(XML.encode())
    assert (tmp_path / "got.xml").read_text() == XML and watchlist.read_xml(spark, str(tmp_path / "got.xml"))["sdnEntry"].count() == 4
    with pytest.raises(OSError):
        watchlist.download(spark, f"{at}/none.xml", str(tmp_path / "none.xml"))
    assert not any(p.name.startswith("none") for p in tmp_path.iterdir())
    server.shutdown()


def test_person_passes(result):
    assert (1, 1) in ids(result.person, "Input_Record_ID", "SDN_UID")
    assert (2, 1, 11) in ids(result.aka, "Input_Record_ID", "SDN_UID", "AKA_UID")
    assert not result.person.filter("SDN_UID = 4").count()  # a listed person without a first name is never matched


def test_org_passes(result):
    assert ids(result.org, "Input_Record_ID", "SDN_UID") == [(3, 2)]
    assert result.org.filter("SDN_Type <> 'Entity'").count() == 0


def test_linked_and_phone(result):
    assert (6, 1) in ids(result.linked, "Input_Record_ID", "SDN_UID")
    phones = {r.Input_Record_ID: r for r in result.phone.collect()}
    assert phones[1].Exact_Match == 1 and phones[1].Last10_Match == 1
    assert phones[6].Exact_Match == 0 and phones[6].Last10_Match == 0


def test_every_record_is_matched_or_not(result, given):
    found = {r[0] for d in (result.person, result.aka, result.org, result.org_aka, result.linked, result.phone) for r in d.select("Input_Record_ID").collect()}
    left = {r[0] for r in result.unmatched.select("Input_Record_ID").collect()}
    assert not found & left
    assert found | left == {r[0] for r in given.select("record_id").collect()}


def test_address(result):
    r = result.address.filter("Input_Record_ID = 1").first()
    assert (r.SDNAddress_UID, r.JaroWinklerMatchStreetAddress, r.City_JaroWinklerSimilarity, r.Country_JaroWinklerSimilarity) == (21, 17, 100.0, 100.0)


def test_score_summary_report(result):
    person = result.gate_passing.filter("Input_Record_ID = 1 AND SDN_UID = 1 AND SDN_Name_Type = 'Regular'").first()
    assert person.MatchDisposition == 100.0 and person.Score_Address == 15.0
    org = result.gate_passing.filter("Input_Record_ID = 3 AND SDN_UID = 2 AND SDN_Name_Type = 'Regular'").first()
    assert org.Score_NameSimilarity > 40 and org.Score_Country == 0.0
    s = result.person_summary.filter("Input_ID = 1 AND SDN_UID = 1").first()
    assert (s.Person_Regular_Match, s.Country_City_Match_Person, s.Input_Person_Regular_Name) == (1, 1, "Ivan Petrov")
    assert result.person_summary.filter("SDN_UID IS NULL").count() == result.unmatched.count() == result.org_summary.filter("SDN_UID IS NULL").count()
    kinds = {r[0] for r in result.report.select("Match_Type").distinct().collect()}
    assert {"Person_Name", "Person_AKA", "Org_Name", "LinkedTo", "Phone"} <= kinds
    assert result.report.filter("Input_Record_ID = 1 AND Match_Type = 'Person_Name'").first().SDN_City == "Moscow"


def test_non_passing(result, given, watch):
    rest = audit.non_passing(given, watch.names(), result.gate_passing)
    pairs = ids(rest.filter("SDN_AKA_UID IS NULL"), "Input_Record_ID", "SDN_UID")
    assert (1, 1) not in pairs and (4, 2) in pairs


def test_blocks_lose_only_what_they_may(given, watch, result):
    free = screen(given, watch, ScreeningConfig(blocking="none"))
    assert set(ids(result.person, "Input_Record_ID", "SDN_UID")) <= set(ids(free.person, "Input_Record_ID", "SDN_UID"))


def test_store_exports_and_runs(spark, given, watch, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    assert store.next_run() == 1 and store.latest_run() is None
    screen(given, watch, store=store)
    assert store.next_run() == 2 and store.latest_run() == 1
    counts = export_run(store, 1, str(tmp_path / "csv"), ["MatchingResults_Person_Full", "Report", "Nothing"])
    assert spark.read.csv(str(tmp_path / "csv/Report"), header=True).count() == counts["Report"]
    store.drop_run("Report", 1)
    assert store.add_missing("Weights", lookups.weights_table(spark), "Weight_Key") == 23
    assert store.add_missing("Weights", lookups.weights_table(spark), "Weight_Key") == 0
    export_csv(spark.range(3).toDF("a"), str(tmp_path / "one"), single=True)
    log = store.read("RunLog", 1).first()
    assert (log.records, log.blocking) == ("7", "letters") and store.read("RunLog", 1).count() == 1
    store.update_run(1, blocking="none", rows=5)
    again = store.read("RunLog", 1).first()
    assert (again.records, again.blocking, again.rows, again.Recorded_At) == ("7", "none", "5", log.Recorded_At)
    screen(given, watch, store=store, run_id=1)  # a run that is repeated replaces its rows
    assert store.read("MatchingResults_Person_Full", 1).count() == counts["MatchingResults_Person_Full"]
    rest = audit.non_passing(given, watch.names(), store.read("MatchingResults_GatePassing", 1))
    rows = audit.non_passing_report(rest, given, "2024-01-31", "2024-02-01 00:00:00")
    export_non_passing(rows, str(tmp_path / "audit"), "2024-02-01 00:00:00", "2024-01-31")
    assert [r.value for r in spark.read.text(str(tmp_path / "audit/preamble")).collect()][:2] == ["Reason for not Including as a match: InsufficientNameMatch", "Run Date: 2024-02-01 00:00:00"]
    back = spark.read.csv(str(tmp_path / "audit/rows"), header=True)
    assert back.count() == rows.count() > 0 and {r[0] for r in back.select("SDNNameType").distinct().collect()} == {"Regular", "AKA"}
    made = dummy.screening_rows(dummy.generate(watch.entries, watch.akas, watch.remarks, watch.addresses, 5, 3))
    for _ in range(2):
        write_back(made, str(tmp_path / "screening"))
    back = spark.read.parquet(str(tmp_path / "screening"))
    assert back.count() == 2 * made.count() and back.filter("ENTITY_NUM = 'DUMMY' AND coalesce(Contact_ID, Entity_ID) LIKE 'DUMMY-%'").count() == back.count()
    assert inputs.from_screening(back.withColumn("ScreeningInput_ID", F.monotonically_increasing_id())).count() == back.count()
    run_log_text(store, 1, str(tmp_path / "log"))


def test_stream(spark, given, watch, tmp_path):
    given.select(*inputs.RAW).write.parquet(str(tmp_path / "in"))
    store = Store(spark, str(tmp_path / "out"))
    q = screen_stream(spark.readStream.schema(given.select(*inputs.RAW).schema).parquet(str(tmp_path / "in")), watch, store, str(tmp_path / "check"), once=True)
    q.awaitTermination()
    assert store.read("MatchingResults_Person_Full", 1).count() >= 1


def test_legacy(spark, tmp_path):
    p = spark.createDataFrame([(1, "Ivan", None, "Petrov", None), (2, None, None, None, "Zzyzx")], "principal_id int, first_name string, middle_name string, last_name string, org_name string")
    e = spark.createDataFrame([(7, "Iwan", "Petrov"), (8, None, "Petroff")], "uid int, first_name string, last_name string")
    rows = legacy.detail(p, e, ScreeningConfig().match_scores)
    assert rows.filter("principal_id = 2").first().match_field == "No Match"
    s = legacy.summary(rows).filter("principal_id = 1").first()
    assert (s.best_uid, s.best_matchtype, s.direct_matches, s.all_matched_uids) == (7, "Direct", 1, "7 | 8")
    export_legacy(rows, legacy.summary(rows), str(tmp_path))
    assert spark.read.csv(str(tmp_path / "summary"), header=True).count() == 2 and "matchtype" in spark.read.csv(str(tmp_path / "detail"), header=True).columns
    other = legacy.detail(p, e, ScreeningConfig().match_scores, double_metaphone).filter("matchtype = 'Double-Metaphone' AND principal_id = 1").collect()
    assert {(r.uid, r.sdn_value) for r in other} == {(7, "petrov"), (8, "petroff")}  # both PTRF; AFN and AN differ
    assert legacy.compare_names(p.withColumnRenamed("principal_id", "given_id"), e).count() > 0


def test_legacy_by_loops(spark):
    """Detail and summary of the older matcher against loops over every key, method, code and listed name."""
    from watchsieve.functions import phonetic

    from .test_functions import plain_jw, plain_osa

    given = [(1, "Ivan", "K", "Petrov", None), (2, "Iwan", None, "Petroff", "Acme"), (3, None, None, "Howard", None), (4, "Zzq", None, "Qqz", None), (5, "ivan", None, "HOWERD", None), (6, "Anna", "Maria", "Lee", None)]
    listed = [(7, "Iwan", "Petrov"), (8, None, "Petroff"), (9, "Ivan", "Howard"), (10, "Hovard", "Acme"), (11, "Anna Maria", "Leigh"), (12, "Ana", "Lee"), (13, "Evan", "Howerd")]
    p = spark.createDataFrame(given, "principal_id int, first_name string, middle_name string, last_name string, org_name string")
    e = spark.createDataFrame(listed, "uid int, first_name string, last_name string")
    names = sorted({x.lower() for r in given for x in r[1:] if x} | {x.lower() for r in listed for x in r[1:] if x} | {" ".join(x for x in two if x).lower() for r in given for two in ((r[2], r[3]), (r[1], r[2])) if all(two)})
    made = spark.createDataFrame([(n,) for n in names], "n string").select("n", phonetic.soundex("n").alias("s"), phonetic.word_codes("n").alias("m"), phonetic.nysiis("n").alias("y")).collect()
    codes = {r.n: {"Direct": [r.n], "Soundex": [r.s] if r.s else [], "Double-Metaphone": list(r.m), "NYSIIS": list(r.y)} for r in made}
    low = lambda x: (x or "").lower()
    scores, want = ScreeningConfig().match_scores, []
    for pid, first, middle, last, org in map(lambda r: (r[0], *map(low, r[1:])), given):
        keys = [(last, "Last_Name", 2), (org, "Org_Name", 2), (f"{middle} {last}" if middle and last else "", "Middle_Name + Last_Name", 2), (first, "First_Name", 1), (f"{first} {middle}" if first and middle else "", "First_Name + Middle_Name", 1)]
        for nth, (key, label, field) in enumerate(keys):
            for m, method in enumerate(legacy.METHODS):
                for code in codes[key][method] if key else ():
                    for r in listed:
                        other = low(r[field])
                        if other and code in codes[other][method]:
                            want.append((pid, f"Matched on {label}", method, r[0], key, other, plain_osa(key, other), round(plain_jw(key, other), 4), scores[method], (nth, m, code, r[0])))
    rows = legacy.detail(p, e, scores)
    got = [(r.principal_id, r.match_field, r.matchtype, r.uid, r.principal_value, r.sdn_value, r.editdistance, round(r.jaro_winkler_similarity, 4), r.match_score) for r in rows.filter("match_field <> 'No Match'").collect()]
    assert sorted(got) == sorted(w[:-1] for w in want) and len(got) > 40
    assert {r.principal_id for r in rows.filter("match_field = 'No Match'").collect()} == {x[0] for x in given} - {w[0] for w in want}
    for r in legacy.summary(rows).collect():
        mine = [w for w in want if w[0] == r.principal_id]
        assert r.total_matches == len(mine) and r.composite_score == sum(w[8] for w in mine)
        assert [r.direct_matches, r.soundex_matches, r.dm_matches, r.nysiis_matches] == [sum(w[2] == m for w in mine) for m in legacy.METHODS]
        if mine:
            best = min(mine, key=lambda w: (legacy.RANK[w[2]], -w[7], w[6], w[9]))
            assert (r.best_uid, r.best_match_field, r.best_matchtype) == (best[3], best[1], best[2])
            assert r.all_matched_uids == " | ".join(str(u) for u in sorted({w[3] for w in mine}, key=lambda u: min(w[9] for w in mine if w[3] == u)))


def test_inputs(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿EntityType,FirstName,LastName,Other\nIndividual, Ann ,Lee,9\n,,,\n")
    rows = inputs.from_csv(spark, str(tmp_path / "a.csv")).collect()
    assert (rows[0].entity_type, rows[0].first_name, rows[0].city) == ("Individual", "Ann", None)
    cells = [(1, *[None] * 11), (3, None, "As of 2024-05-06 07:08:09", *[None] * 9), (12, None, "Acme", None, None, "Ann", "Lee", None, "1 Road, Jersey", None, None, None), (13, *[None] * 11)]
    grid = spark.createDataFrame(cells, "row_number int, " + ", ".join(f"{k} string" for k in "ABCDEFGHIJK"))
    r = inputs.from_sheet(grid).collect()
    assert [(x.ORG_NAME, x.ADDRESS1, x.COUNTRY, str(x.Upload_Date)) for x in r] == [("Acme", "1 Road", "Jersey", "2024-05-06 07:08:09")]
    cells = [(1, "Contact: Contact ID", *[None] * 10), (2, "c", "e", "Acme", "Ann", "Lee", None, "1 Road", "Rome", None, "00100", "Italy"), (3, *[None] * 11)]
    r = inputs.from_sheet(spark.createDataFrame(cells, grid.schema)).collect()
    assert [(x.Contact_ID, x.ORG_NAME, x.COUNTRY) for x in r] == [("c", "Acme", "Italy")]
    s = spark.createDataFrame([(5, "Acme", None, "Ann", None, "Lee"), (6, None, "Only Org", None, None, None), (7, None, None, None, None, " ")], "ScreeningInput_ID bigint, ENTITY_NAME string, ORG_NAME string, FIRST_NAME string, MIDDLE_NAME string, LAST_NAME string")
    got = inputs.from_screening(s).collect()
    assert [(x.source_id, x.entity_type, x.entity_name) for x in got] == [(5, "Entity", "Acme"), (5, "Individual", "Acme"), (6, "Entity", "Only Org")]
    assert [x.entity_name for x in inputs.from_screening(s, strict_reference=True).collect()] == ["Acme", "Acme", None]
    (tmp_path / "f_2024-01-02.txt").write_text("x")
    (tmp_path / "f_2023-09-09.txt").write_text("x")
    assert inputs.latest_file(spark, str(tmp_path), "f_*.txt").endswith("f_2024-01-02.txt")


def test_workbook(spark, tmp_path):
    """A workbook with shared, inline and plain values is read as its grid."""
    import zipfile

    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    sheet = f'''<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c></row><row r="2"><c r="A2" t="inlineStr"><is><t>c1</t></is></c><c r="B2"><v>42</v></c><c r="C2" t="s"><v>1</v></c><c r="K2" t="s"><v>2</v></c><c r="L2"><v>9</v></c></row><row r="5"><c r="D5"/></row></sheetData></worksheet>'''
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Contact: Contact ID</t></si><si><r><t>Acme </t></r><r><t>Ltd</t></r></si><si><t>Italy</t></si></sst>")
    grid = inputs.read_xlsx(spark, str(tmp_path / "a.xlsx"))
    assert [(r.row_number, r.A, r.B, r.C, r.K) for r in grid.collect()] == [(1, "Contact: Contact ID", None, None, None), (2, "c1", "42", "Acme Ltd", "Italy"), (5, None, None, None, None)]
    assert [(r.Contact_ID, r.Entity_ID, r.ORG_NAME, r.COUNTRY) for r in inputs.from_sheet(grid).collect()] == [("c1", "42", "Acme Ltd", "Italy")]


def test_lookups(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Address_Part_Abbreviation,Address_Part,Skip_At_Beginning\nQy,Quay,1\n")
    assert lookups.abbreviations(spark, str(tmp_path / "a.csv")) == [("#", "Number", 0), ("Qy", "Quay", 1)]
    assert lookups.weights(spark, spark.createDataFrame([("Address_Full", 9.0)], "Weight_Key string, Weight_Value double"))["Address_Full"] == 9.0
    j = lookups.jurisdictions(spark)
    us = j.filter("Jurisdiction = 'United States' AND Juris_Type = 'Country'").first().ID
    assert j.filter(F.col("Parent_ID") == us).count() == 56
    assert lookups.dates(spark, "2024-02-28", "2024-03-01").filter("Is_Leap_Year = 1").count() == 3


def test_dummy(watch):
    made = dummy.generate(watch.entries, watch.akas, watch.remarks, watch.addresses, 5, 3).collect()
    assert {r.external_id.split("-")[1] for r in made} == {"P", "PAKA", "E", "EAKA", "LT"}
    assert 0.75 <= dummy.jw_one("ALEXANDER", dummy.perturbed_one("ALEXANDER", 1)) <= 0.99


def test_registered(spark):
    register(spark)
    r = spark.sql("SELECT jaro_winkler('MARTHA', 'MARHTA') AS w, osa_distance('ab', 'ba') AS o, nysiis_codes('KNIGHT SHEIKH') AS n, token_match('acme bank', 'bank acme').category AS t, jw_similarity('ab', 'ab') AS j, org_score('ACME LIMITED', 'ACME LIMITED').passed AS p").first()
    assert (round(r.w, 4), r.o, r.n, r.p, r.t, r.j) == (0.9611, 1, ["NAGT", "SAC"], True, "All", 1.0)


def test_legacy_queries_take_whole_tables(spark, tmp_path):
    """Whatever the ids, each person is compared with each, as in a plain loop over all pairs."""
    from watchsieve.plans.queries import QUERIES

    names = ["Ivan Petrov", "Anna Maria", "Ivan Sidorov", "Olga Petrov", "Anna Schmidt", "Karl Weber"]
    spark.createDataFrame([(3 + 7 * i, f"{n} and more") for i, n in enumerate(names)], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    who = {3 + 7 * i: n.split() for i, n in enumerate(names)}
    got = {q: QUERIES[q](spark, str(tmp_path)).collect() for q in ("m15_compare_names", "x15_legacy_detail", "a4_w4_a7_legacy_summary", "j14_j15_name_candidates")}
    alike = lambda part: {(a, b) for a in who for b in who if who[a][part] == who[b][part]}
    pairs = {q: {(r.principal_id if "principal_id" in r else r.given_id, r.uid) for r in rows} for q, rows in got.items() if q != "a4_w4_a7_legacy_summary"}
    assert pairs["x15_legacy_detail"] >= alike(0) | alike(1) and pairs["j14_j15_name_candidates"] >= alike(0)
    assert pairs["m15_compare_names"] >= alike(0) & alike(1)
    assert {r.principal_id for r in got["a4_w4_a7_legacy_summary"]} == set(who)


def test_persons_of_the_same_names_are_compared_once(spark):
    """Rows between representatives, with who they stand for, are those between all; and no pair is moved."""
    who = [(1, "Ivan", None, "Petrov", None), (2, "Ivan", None, "Petrov", None), (3, "Petrov", "van", "Ivan", "Acme"), (4, "Zoe", None, "Acme", None), (4, "Zoe", None, "Acme", None)]
    given = spark.createDataFrame(who, "given_id bigint, first_name string, middle_name string, last_name string, org_name string")
    listed = spark.createDataFrame([(7, "Ivan", "Petrow"), (5, "Ivan", "Petrow"), (6, None, "Acme")], "uid bigint, first_name string, last_name string")
    every = [tuple(r) for r in legacy.compare_names(given, listed).collect()]
    rows = legacy.compare_name_classes(given, listed)
    assert "Exchange" not in rows.filter("method = 'Direct'")._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0].replace("BroadcastExchange", "")
    rows = rows.collect()
    same = {f: [(r.given_id, r.uid) for r in rows if r.fields == f] for f in ("given", "listed")}
    assert sorted(same["given"]) == [(1, 1), (2, 1), (3, 3), (4, 4), (4, 4)] and sorted(same["listed"]) == [(5, 5), (6, 6), (7, 5)]
    spread = [(r.x, r.y, g, u, *r[4:]) for r in rows if r.method != "Same fields" for g, a in same["given"] if a == r.given_id for u, b in same["listed"] if b == r.uid]
    assert sorted(spread) == sorted(every) and len(every) > 0
    matched = {(r[0], r[1], r[5]): r[6] for r in every}
    assert matched["Ivan", "Ivan", "Soundex"] == 1 and matched["Petrov", "Petrow", "Direct"] == 0


def _places(spark, pick):
    records = inputs.normalized(spark.createDataFrame([(k, f"e{k}", f"{k % 3} Main Street", ["Bern", "Berne", "Lima"][k % 3], ["Peru", "Chad"][k % 2]) for k in pick], "record_id bigint, external_id string, address1 string, city string, country string"))
    listed = spark.createDataFrame([(k // 2 if k < 6 else k, k, f"{k % 4} Main Street", ["Bern", "Lima", "Rome"][k % 3], ["Peru", "Chad"][k % 2]) for k in range(12)], "uid bigint, addr_uid bigint, address1 string, city string, country string")
    return records, inputs.normalized(listed), records.select(F.col("record_id").alias("Input_Record_ID"), F.lit(None).cast("bigint").alias("SDN_UID"))


def test_pairs_of_addresses_are_not_moved(spark):
    plan = passes.address(*_places(spark, range(9)), ScreeningConfig()).select("Input_Record_ID", "SDNAddress_UID", "City_JaroWinklerSimilarity")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("MapInArrow")[0].replace("BroadcastExchange", "")


def test_best_addresses_in_parts(spark):
    given = _places(spark, [*range(9), 3])  # a record twice, parties with one and with two addresses
    whole = passes.address(*given, ScreeningConfig())
    alone, rest = passes.address_parts(*given, ScreeningConfig())
    assert 0 < alone.count() < whole.count() == alone.count() + rest.count()
    for one, other in ((summary.address_best(whole), summary.address_best(rest, alone)), (report.best_address(whole), report.best_address(rest, alone=alone))):
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))


def test_matched_parties_are_met_by_key(spark):
    records, listed, _ = _places(spark, range(9))
    matched = spark.createDataFrame([(k, k % 5) for k in range(9)], "Input_Record_ID bigint, SDN_UID bigint")
    whole = passes.address(records, listed, matched, ScreeningConfig())
    some = whole.join(matched.withColumnRenamed("SDN_UID", "SDNEntry_UID"), ["Input_Record_ID", "SDNEntry_UID"], "left_semi").select(whole.columns)
    met = passes.address(records, listed, matched, ScreeningConfig(restrict_to_matched_party=True))
    assert sorted(map(repr, some.collect())) == sorted(map(repr, met.collect())) != []
    assert "MapInArrow" not in met._jdf.queryExecution().executedPlan().toString()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_address_candidates_look_up_equal_words_once(spark):
    given = spark.createDataFrame([(k, f"{k} Peru St") for k in range(200)] + [(7, "Lima Peru"), (900, "of St")], "given_id bigint, address string")
    listed = spark.createDataFrame([(k, ["Peru Road", "Lima Peru Road", "Oslo"][k % 3]) for k in range(90)], "addr_uid bigint, address string")
    found = legacy.address_candidates(given, listed, 5)
    got = {}
    for g, u, n in found.select("given_id", "addr_uid", "words").collect():
        got.setdefault(g, []).append((u, n))
    assert sorted(got) == [*range(200)] and sorted(got[3]) == [(0, 1), (1, 1), (3, 1), (4, 1), (6, 1)]
    assert sorted(got[7]) == [(k, 2) for k in (1, 4, 7, 10, 13)]


def test_rows_of_one_name_spread_after_the_last_shuffle(spark, monkeypatch):
    monkeypatch.setattr(blocking, "TOGETHER", 7)
    left = spark.createDataFrame([(k, "ANNA" if k % 3 else "OTTO") for k in range(60)] + [(3, "OTTO")], "a_id bigint, a string")
    right = spark.createDataFrame([(k, "ANNE" if k % 2 else "OTTO") for k in range(50)], "b_id bigint, b string")
    found = blocking.fuzzy_join(left, right, ("a", "b"), 0.8, similarity="sim")
    want = sorted((x.a_id, y.b_id) for x in left.collect() for y in right.collect() if x.a[0] == y.b[0])
    assert sorted((r.a_id, r.b_id) for r in found.collect()) == want
    assert _plan(found).split("Generate")[1].count("Exchange") == 0  # nothing is moved above the arrays


def test_name_candidates_spread_after_the_last_shuffle(spark):
    given = spark.createDataFrame([(1, "Anna"), (1, "Otto"), (2, "anna "), (3, "Ulm"), (4, None)], "given_id bigint, name string")
    listed = spark.createDataFrame([(7, "ANNA"), (8, "Otto"), (8, "Anna"), (9, "Ole")], "uid bigint, name string")
    found = legacy.name_candidates(given, listed)
    assert ids(found, "given_id", "uid") == [(1, 7), (1, 8), (2, 7), (2, 8)]
    assert "Aggregate" not in _plan(found).split("Generate")[0] and "Exchange" not in _plan(found).split("Generate")[1]


def test_passing_pairs_are_taken_out_where_they_are_made(spark):
    records = spark.createDataFrame([(k, "Individual" if k < 3 else "Entity") for k in range(5)], "record_id bigint, entity_type string")
    names = spark.createDataFrame([(1, None, "individual", "a"), (1, 11, "individual", "b"), (2, None, "Entity", "c")], "uid bigint, aka_uid bigint, sdn_type string, name string")
    passing = spark.createDataFrame([(0, 1, None), (1, 1, 11), (1, 1, 11), (2, 1, 12), (3, 2, None)], "Input_Record_ID bigint, SDN_UID bigint, SDN_AKA_UID bigint")
    rest = audit.non_passing(records, names, passing)
    assert {tuple(r) for r in rest.select("Input_Record_ID", "SDN_UID", "SDN_AKA_UID").collect()} == {(0, 1, 11), (1, 1, None), (2, 1, None), (2, 1, 11), (4, 2, None)}
    assert "LeftAnti" not in _plan(rest)


def _similar(a, b, least):
    return [x for p in a for q in b if (x := jw_pairs([p.encode()], [q.encode()])[0]) >= least]


def test_similar_names_are_found_without_a_nested_loop(spark, monkeypatch):
    monkeypatch.setattr(blocking, "LOOP_ROWS", 9)  # several chunks
    words = ["ANNA", "ANNE", "HANNA", "OTTO", "OTO", "A", "AN", "MARTHA", "MARHTA", "DIXON", "DICKSONX", "X" * 70 + "Y", "X" * 69 + "YZ", "ANNA" * 70]
    given = [(words[k], words[(3 * k + j) % len(words)]) for k in range(len(words)) for j in range(4)]
    listed = [(words[(2 * k + j) % len(words)], words[(3 * k + 1) % len(words)]) for k in range(len(words)) for j in range(3)]
    found = blocking.person_pairs(spark.createDataFrame([*{*given}], "fn string, ln string"), spark.createDataFrame(listed, "sdn_fn string, sdn_ln string"), 0.85, "none")
    want = {(*g, *n, round(x[0] * 100, 2), round(y[0] * 100, 2)) for g in given for n in listed if (x := _similar(g[:1], n[:1], 0.85)) and (y := _similar(g[1:], n[1:], 0.85))}
    got = [tuple(r) for r in found.select("fn", "ln", "sdn_fn", "sdn_ln", "fn_jw", "ln_jw").collect()]
    assert len(got) == len({*got}) and {*got} == want and len(want) > 20
    assert "NestedLoop" not in _plan(found)
    one = blocking.alike(spark.createDataFrame([(w,) for w in [*words, ""]], "a string"), spark.createDataFrame([(w,) for w in [*words, ""]], "b string"), 0.9, "sim")
    assert sorted((r.a, r.b) for r in one.collect()) == sorted((a, b) for a in words for b in words if _similar([a], [b], 0.9))
    none = blocking.alike(spark.createDataFrame([("ANNA",)], "a string"), spark.createDataFrame([], "b string"), 0.9, "sim")
    assert none.count() == 0


def test_listed_names_may_come_in_several_batches(spark):
    """Linked parties and all passes together meet names by alike(), unblocked persons by person_pairs()."""
    listed = spark.createDataFrame([("ANNA", "OTT"), ("ANNA", "OTTO"), ("BO", "LI"), ("ANNE", "OTT")], "sdn_fn string, sdn_ln string").repartition(4)
    given = spark.createDataFrame([("ANNA", "OTT")], "fn string, ln string")
    assert sorted(r.sdn_fn for r in blocking.alike(given.select("fn"), listed.select("sdn_fn"), 0.85, "sim").collect()) == ["ANNA", "ANNA", "ANNE"]
    assert sorted((r.sdn_fn, r.sdn_ln) for r in blocking.person_pairs(given, listed, 0.85, "none").collect()) == [("ANNA", "OTT"), ("ANNA", "OTTO"), ("ANNE", "OTT")]
    assert blocking.person_pairs(given, listed.filter("sdn_fn = ''"), 0.85, "none").count() == 0


def test_fuzzy_join_compares_names_in_the_tasks(spark, monkeypatch):
    monkeypatch.setattr(blocking, "LOOP_ROWS", 3)  # several chunks
    words = ["ANNA", "ANNE", "HANNA", "OTTO", "OTO", "", None, "MARTHA", "MARHTA", "Ł", "ANNA"]
    names = spark.createDataFrame([*enumerate(words)], "id int, a string")
    left, right = names.withColumnRenamed("id", "x"), names.selectExpr("id AS y", "a AS b")
    found = blocking.fuzzy_join(left, right, ("a", "b"), 0.8, similarity="sim")
    want = {(i, j, s[0]) for i, a in enumerate(words) for j, b in enumerate(words) if a and b and (s := _similar([a], [b], 0.8))}
    got = [tuple(r) for r in found.select("x", "y", "sim").collect()]
    assert len(got) == len({*got}) and {*got} == want and len(want) > 15
    assert "MapInArrow" in _plan(found) and "NestedLoop" not in _plan(found)
    assert blocking.fuzzy_join(left, right, ("a", "b"), 0.0).filter("a IS NOT NULL").count() == 100  # empty ones too where nothing is asked for


def test_pairs_of_organisations_are_dealt_over_all_tasks(spark, given, watch):
    matched, near = passes.org_primary(given, watch.entries, ScreeningConfig())
    assert all(d._jdf.queryExecution().optimizedPlan().toString().count("Repartition 4, true") == 1 for d in (matched, near))
    assert {(r.Input_Record_ID, r.SDN_UID) for r in matched.collect()} >= {(3, 2)}


def test_linked_names_are_met_without_a_nested_loop(spark, given, watch):
    found = passes.linked_to(given.filter("entity_type = 'Individual'"), watch.remarks, ScreeningConfig())
    assert "MapInArrow" in _plan(found) and "jaro_winkler" not in _plan(found)
    rows = inputs.normalized(spark.createDataFrame([(1, "Individual", "Anna", "Ott"), (2, "Individual", "Anna", "Ott"), (3, "Individual", "Ott", "Anna")], "record_id bigint, entity_type string, first_name string, last_name string"))
    remarks = spark.createDataFrame([(7, 1, "Anna Ott", "ANNA OTT", ""), (8, 1, "Anna Otto", "ANNA OTTO", ""), (8, 2, "Bo Li", "BO LI", "")], "uid int, occurrence int, text string, text_nm string, text_expanded string")
    got = passes.linked_to(rows, remarks, ScreeningConfig()).select("Input_Record_ID", "SDN_UID", "Input_Name_Form", "SourceName").collect()
    assert sorted(map(tuple, got)) == sorted((r, u, "LN_FN_MN" if r == 3 else "FN_MN_LN", "Anna Ott") for r in (1, 2, 3) for u in (7, 8))


def test_legacy_summary_without_its_detail(spark):
    people = [(1, "Anna", None, "Ott", None), (2, "anna ", "Bo", "Otto", None), (3, "Anne", None, "Ulm", "Otto"), (3, "Bo", None, "Ott", None), (4, None, None, "Xyz", None), (4, None, None, "Xyz", None), (5, None, None, None, None), (6, "Anna", None, "Ott", None)]
    given = spark.createDataFrame(people, "principal_id bigint, first_name string, middle_name string, last_name string, org_name string")
    listed = spark.createDataFrame([(10, "Anna", "Ott"), (9, "Ana", "Otto"), (100, "Hanna", "Utt"), (10, "Bo", "Ott"), (7, "Bo", "Anna"), (8, None, "Bo Ott")], "uid bigint, first_name string, last_name string")
    points = ScreeningConfig().match_scores
    want, got = legacy.summary(legacy.detail(given, listed, points)), legacy.summarized(given, listed, points)
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))
    assert [(f.name, f.dataType) for f in got.select(want.columns).schema] == [(f.name, f.dataType) for f in want.schema]
    assert "Exchange" not in _plan(got).split("MapInArrow")[0]  # the long lists of parties are never moved


def test_legacy_detail_spreads_after_the_last_shuffle(spark, monkeypatch):
    monkeypatch.setattr(blocking, "TOGETHER", 3)
    given = spark.createDataFrame([(k, ["Anna", "Anne", "Bo", ""][k % 4], None, ["Ott", "Otto", None][k % 3], "Ott" if k == 5 else None) for k in range(14)] + [(1, "Anne", None, "Otto", None)], "principal_id bigint, first_name string, middle_name string, last_name string, org_name string")
    listed = spark.createDataFrame([(k, ["Anna", "Bo", "Xi"][k % 3], ["Otto", "Ulm"][k % 2]) for k in range(11)], "uid bigint, first_name string, last_name string")
    found = legacy.detail(given, listed, ScreeningConfig().match_scores)
    hits = legacy.hits(given, listed)
    key = lambda df, *c: sorted(map(repr, df.select(*c).collect()))
    real = found.filter("match_field <> 'No Match'")
    assert [x.split("(")[1] for x in key(real.selectExpr("principal_id a", "uid b", "match_field c", "matchtype d", "principal_value e", "sdn_value f", "ord.code g"), "*")] == [x.split("(")[1] for x in key(hits.selectExpr("principal_id a", "uid b", "label c", "method d", "key e", "listed f", "code g"), "*")] != []
    assert {r.principal_id for r in found.filter("match_field = 'No Match'").collect()} == {r.principal_id for r in given.collect()} - {r.principal_id for r in hits.collect()}
    assert _plan(real).split("Generate")[2].count("Exchange") == 0  # nothing is moved between the arrays and the rows


def test_edit_distances_of_many_pairs():
    words = ["".join(x) for n in range(5) for x in itertools.product("abc", repeat=n)][::3] + ["żółć", "żłóć", "kitten", "sitting"]
    a, b = ([*x] for x in zip(*itertools.product(words, words), strict=True))
    assert osa_many(a, b).tolist() == [osa_one(x, y) for x, y in zip(a, b, strict=True)]
    assert osa_many([], []).tolist() == []


def test_audit_rows_from_pairs_of_names(given, watch):
    """The rows of the four passes joined one by one, also where a record, a party and an address come twice; no row of a pair is shuffled."""
    from watchsieve.operators import passing, score

    config = ScreeningConfig()
    twice = given.union(given.filter("record_id IN (1, 3)"))
    listed = watchlist.WatchList(watch.entries, watch.akas, watch.addresses.union(watch.addresses.withColumn("addr_uid", F.col("addr_uid") + 1).withColumn("country_nm", F.lit("FRANCE"))), watch.remarks, watch.phones)
    names = audit.passing_names(passes.person_primary(twice, listed.entries, config), passes.person_aka(twice, listed.akas, config), passes.org_primary(twice, listed.entries, config), passes.org_aka(twice, listed.akas, config))
    plain = audit.gate_passing(names, twice, listed.entries, listed.addresses)
    want, got = score.composite(plain, listed.names()), passing.rows(twice, listed, config, scored=True)
    assert want.columns == got.columns and want.count() > 4
    assert sorted(map(repr, want.collect())) == sorted(map(repr, got.collect()))
    assert got._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[0].count("Repartition") == 0
