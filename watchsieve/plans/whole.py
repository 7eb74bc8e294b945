"""SQL of what needs several passes together: audit rows, scores, summaries and the report, over all records and the whole list."""

from __future__ import annotations

from ..functions import tables
from .samples import ORG_BASE, PARTS, PEOPLE, PHONES, PLACES, address, country, gate, jw, nm, org, ph, state

PERSONS = f"""{PEOPLE}, i AS (SELECT doc_id, fn, ln, {ph(nm("fn"))} AS f, {ph(nm("ln"))} AS l FROM people WHERE doc_id % 5 >= 2),
u AS (SELECT doc_id, fn, ln, {ph(nm("fn"))} AS f, {ph(nm("ln"))} AS l FROM people WHERE doc_id % 5 = 0),
k AS (SELECT doc_id, fn, ln, {ph(nm("fn"))} AS f, {ph(nm("ln"))} AS l FROM people WHERE doc_id % 5 = 1 AND doc_id - 1 IN (SELECT doc_id FROM u))"""
NEAR = "left(i.f, 1) = left(w.f, 1) AND left(i.l, 1) = left(w.l, 1) AND abs(length(i.f) - length(w.f)) <= 3 AND abs(length(i.l) - length(w.l)) <= 3"
SIMILAR = "jaro_winkler_similarity(i.f, w.f) >= 0.85 AND jaro_winkler_similarity(i.l, w.l) >= 0.85"
_JWS = f"{jw('i.f', 'w.f')} AS FirstName_JaroWinklerSimilarity, {jw('i.l', 'w.l')} AS LastName_JaroWinklerSimilarity, 1::INT AS Personal_Name_Match"
_SOURCE = "i.fn AS SourceFN, NULL::VARCHAR AS SourceMN, i.ln AS SourceLN, i.f AS SourceFN_NM, '' AS SourceMN_NM, i.l AS SourceLN_NM"
X1 = f"SELECT i.doc_id AS Input_Record_ID, {_SOURCE}, w.doc_id AS SDN_UID, w.fn AS SDNFN, w.ln AS SDNLN, 'Individual' AS SDN_Type, 'sdnEntry' AS SDN_AKA_Source, {_JWS} FROM i JOIN u w ON {NEAR} AND {SIMILAR}"
X2 = f"SELECT i.doc_id AS Input_Record_ID, w.doc_id - 1 AS SDN_UID, w.doc_id AS AKA_UID, CASE WHEN w.doc_id % 2 = 0 THEN 'strong' ELSE 'weak' END AS AKA_Category, {_SOURCE}, w.fn AS SDNFN, w.ln AS SDNLN, {_JWS} FROM i JOIN k w ON {NEAR} AND {SIMILAR}"

ORGS = f"""{PARTS}, i AS (SELECT p_partkey + {ORG_BASE} AS id, name, {org("name")} AS n FROM parts WHERE p_partkey % 97 > 1), u AS (SELECT p_partkey + {ORG_BASE} AS id, name, {org("name")} AS n FROM parts WHERE p_partkey % 97 = 0),
k AS (SELECT p_partkey + {ORG_BASE} AS id, name, {org("name")} AS n FROM parts WHERE p_partkey % 97 = 1),
near AS (SELECT i.id AS iid, i.name AS iname, i.n AS a, w.id AS wid, w.name AS wname, w.n AS b, w.kind FROM i JOIN (SELECT *, 0 AS kind FROM u UNION ALL SELECT *, 1 FROM k) w ON left(i.n, 2) = left(w.n, 2) AND abs(length(i.n) - length(w.n)) <= greatest(6, length(i.n) / 3)),
{gate("near")}"""
ENOUGH = "matched >= CASE WHEN sdn_words = 1 THEN 1 ELSE 2 END"
_ORG_OUT = "iname AS SourceOrgName, a AS SourceOrgName_NM, wname AS SDNOrgName, b AS SDNOrgName_NM, 'Entity' AS SDN_Type, {source} AS SDN_AKA_Source, src_words AS SourceNumberofWords, sdn_words AS SDNNumberofWords, matched AS WordNumberMatchingJaroWinkler, full_jw AS FullName_JaroWinklerSimilarity"
_CATEGORY = "CASE WHEN wid % 2 = 0 THEN 'strong' ELSE 'weak' END AS AKA_Category"
X3 = "SELECT iid AS Input_Record_ID, wid AS SDN_UID, " + _ORG_OUT.format(source="'sdnEntry'") + " FROM near JOIN s4 USING (a, b) WHERE kind = 0 AND passed"
X3N = "SELECT iid AS Input_Record_ID, wid AS SDN_UID, " + _ORG_OUT.format(source="'sdnEntry'") + f" FROM near JOIN s4 USING (a, b) WHERE kind = 0 AND NOT passed AND {ENOUGH}"
X4 = f"SELECT iid AS Input_Record_ID, wid - 1 AS SDN_UID, wid AS AKA_UID, {_CATEGORY}, " + _ORG_OUT.format(source="'akaList'") + " FROM near JOIN s4 USING (a, b) WHERE kind = 1 AND passed"

_REMARKS = f"""rem AS (SELECT doc_id AS uid, fn || ' ' || ln AS text FROM people WHERE doc_id % 25 = 0 UNION ALL SELECT p_partkey + {ORG_BASE}, rtrim(split_part(name, '.', 1)) FROM parts WHERE p_partkey % 97 = 0),
remarks AS (SELECT uid, 1::INT AS occurrence, text, {ph(nm("text"))} AS t, {org("text")} AS e FROM rem)"""
_LINK = "uid AS SDN_UID, occurrence AS LinkedTo_Occurrence, text AS LinkedTo_Text, t AS LinkedTo_Text_NM, e AS LinkedTo_Text_NM_Expanded"
#: Linked parties among persons, by all remarks, and among organisations.
X5P = f"""WITH {PERSONS}, {PARTS}, {_REMARKS}, forms AS (SELECT doc_id, 'FN_MN_LN' AS form, fn || ' ' || ln AS raw, f || ' ' || l AS n FROM i UNION ALL SELECT doc_id, 'LN_FN_MN', ln || ' ' || fn, l || ' ' || f FROM i)
SELECT doc_id AS Input_Record_ID, {_LINK}, raw AS SourceName, n AS SourceName_NM, form AS Input_Name_Form, {jw("lower(n)", "lower(t)")} AS FullName_JaroWinklerSimilarity FROM forms JOIN remarks ON {jw("lower(n)", "lower(t)")} >= 85"""
X5O = f"""WITH {PEOPLE}, {PARTS}, {_REMARKS}, i AS (SELECT p_partkey + {ORG_BASE} AS id, name, {org("name")} AS n FROM parts WHERE p_partkey % 97 > 1),
near AS (SELECT i.id, i.name, i.n AS a, remarks.*, e AS b FROM i, remarks WHERE e <> ''), {gate("near")}
SELECT id AS Input_Record_ID, {_LINK}, name AS SourceName, a AS SourceName_NM, 'EntityName' AS Input_Name_Form, full_jw AS FullName_JaroWinklerSimilarity, src_words AS SourceNumberOfWords, sdn_words AS LinkedToNumberOfWords, matched AS WordNumberMatchingJaroWinkler FROM near JOIN s4 USING (a, b) WHERE passed"""
_LINKED = "Input_Record_ID, SDN_UID, Input_Name_Form, SourceName, LinkedTo_Text, FullName_JaroWinklerSimilarity"

_PHONES = r"""x AS (SELECT p.doc_id, phone, regexp_replace(phone, '\D', '', 'g') AS g FROM phones p JOIN people USING (doc_id)), j AS (SELECT * FROM x WHERE doc_id % 5 >= 2),
v AS (SELECT q.doc_id, CASE WHEN q.doc_id % 25 = 0 THEN phone ELSE phone END AS raw, regexp_replace(phone, '\D', '', 'g') AS g FROM phones p JOIN people q ON q.doc_id = p.doc_id - 2 WHERE q.doc_id % 5 = 0),
hit AS (SELECT j.doc_id AS i, j.phone AS ip, j.g AS ig, v.doc_id AS w FROM j JOIN v ON right(j.g, 7) = right(v.g, 7))"""
X6 = f"WITH {PEOPLE}, {PHONES}, {_PHONES} SELECT i AS Input_Record_ID, w AS SDN_UID, v.raw AS SDN_Phone_Raw, v.g AS SDN_Phone_Digits, ip AS Input_Phone_Raw, ig AS Input_Phone_Digits, (ig = v.g)::INT AS Exact_Match, (length(ig) >= 10 AND length(v.g) >= 10 AND right(ig, 10) = right(v.g, 10))::INT AS Last10_Match, {jw('ig', 'v.g')} AS JaroWinkler_Digits FROM hit JOIN v ON v.doc_id = w"

_STREETS = "[" + ", ".join("concat_ws(' ', " + ", ".join(f"s{k}" for k in o if k < 3) + ")" if any(k < 3 for k in o) else "''" for o in tables.STREET_ORDERS) + "]"
_PLACE = f"{nm('city')} AS c, {state('region')} AS r, {nm('postal_code')} AS p, {country('country')} AS t, city, country"


def addresses(given: str, listed: str) -> str:
    """SQL views g, l and z: given addresses (id and lines), listed ones (id, uid and lines), and the pairs that the address pass keeps."""
    return f"""g AS (SELECT id, concat_ws(' ', {address("address1")}, {address("address2")}) AS m, {_PLACE} FROM {given}),
l AS (SELECT id, uid, {address("address1")} AS s1, {address("address2")} AS s2, {_PLACE} FROM {listed}),
y AS (SELECT g.id AS Input_Record_ID, l.uid AS SDN_UID, l.id AS SDNAddress_UID, coalesce(list_position([jaro_winkler_similarity(m, x) >= 0.7 FOR x IN {_STREETS}], true) + 16, 32)::INT AS JaroWinklerMatchStreetAddress,
  {jw("g.c", "l.c")} AS City_JaroWinklerSimilarity, {jw("g.r", "l.r")} AS StateProvince_JaroWinklerSimilarity, {jw("g.p", "l.p")} AS PostalCode_JaroWinklerSimilarity, {jw("g.t", "l.t")} AS Country_JaroWinklerSimilarity,
  g.city AS SourceCity, l.city AS SDNCity, g.country AS SourceCountry, l.country AS SDNCountry FROM g, l),
z AS (SELECT * FROM y WHERE JaroWinklerMatchStreetAddress <> 32 OR City_JaroWinklerSimilarity >= 70 OR PostalCode_JaroWinklerSimilarity >= 70 OR Country_JaroWinklerSimilarity >= 70)"""


#: What each pass finds (m, n: persons; o, q: organisations; lt: linked parties; f: phones), the records that none does, and z, the addresses of matched records.
FOUND = f"""m AS (WITH {PERSONS} {X1}), n AS (WITH {PERSONS} {X2}), o AS (WITH {ORGS} {X3}), q AS (WITH {ORGS} {X4}), lt AS (SELECT {_LINKED} FROM ({X5P}) UNION ALL SELECT {_LINKED} FROM ({X5O})), f AS ({X6}),
matched AS (SELECT Input_Record_ID, SDN_UID FROM m UNION SELECT Input_Record_ID, SDN_UID FROM n UNION SELECT Input_Record_ID, SDN_UID FROM o UNION SELECT Input_Record_ID, SDN_UID FROM q UNION SELECT Input_Record_ID, SDN_UID FROM lt UNION SELECT Input_Record_ID, SDN_UID FROM f),
{PEOPLE}, {PARTS}, records AS (SELECT doc_id AS id FROM people WHERE doc_id % 5 >= 2 UNION ALL SELECT p_partkey + {ORG_BASE} FROM parts WHERE p_partkey % 97 > 1),
unmatched AS (SELECT id FROM records WHERE id NOT IN (SELECT Input_Record_ID FROM matched)), {PLACES},
{addresses("(SELECT * FROM customers WHERE id IN (SELECT Input_Record_ID FROM matched) AND id IN (SELECT doc_id FROM people))", "(SELECT *, id * 5 AS uid FROM suppliers WHERE id * 5 IN (SELECT doc_id FROM people))")},
best AS (SELECT Input_Record_ID, SDN_UID, max(City_JaroWinklerSimilarity) AS City_JW, max(Country_JaroWinklerSimilarity) AS Country_JW, max((City_JaroWinklerSimilarity >= 85 AND Country_JaroWinklerSimilarity >= 85)::INT) AS CC_Match,
  max(SourceCity) AS Input_City, max(SDNCity) AS SDN_City, max(SourceCountry) AS Input_Country, max(SDNCountry) AS SDN_Country FROM z GROUP BY ALL)"""


def summary(parts: list[tuple[str, str, str, dict[str, str], str, str]]) -> str:
    """parts: prefix of its columns, that of its places, a source, its scores, and the given and listed names. One row for each input and party, and one for each record without a match."""
    views, columns, flags, joins = [], ["c.Input_Record_ID AS Input_ID", "c.SDN_UID"], [], ""
    for prefix, _, source, scores, given, listed in parts:
        v = f"g_{prefix}"
        views.append(f"{v} AS (SELECT Input_Record_ID, SDN_UID, {', '.join(f'max({x}) AS {k}' for k, x in scores.items())}, max({given}) AS Input_Name, max({listed}) AS SDN_Name, 1 AS hit FROM {source} GROUP BY Input_Record_ID, SDN_UID)")
        columns += [f"coalesce({v}.hit, 0)::INT AS {prefix}_Match", f"{v}.Input_Name AS Input_{prefix}_Name", f"{v}.SDN_Name AS SDN_{prefix}_Name", f"CASE WHEN {v}.hit = 1 THEN c.SDN_UID::VARCHAR END AS SDN_{prefix}_Match", *[f"{v}.{k} AS {prefix}_Match_{k}" for k in scores]]
        joins += f" LEFT JOIN {v} ON {v}.Input_Record_ID = c.Input_Record_ID AND {v}.SDN_UID = c.SDN_UID"
    for prefix, at, *_ in parts:
        hit = f"g_{prefix}.hit = 1"
        columns += [f"coalesce({hit} AND best.CC_Match = 1, false)::INT AS Country_City_Match_{at}", *[f"CASE WHEN {hit} THEN best.{x} END AS {x}_{at}" for x in ("Input_City", "SDN_City", "Input_Country", "SDN_Country")]]
        columns += [f"CASE WHEN {hit} THEN best.{x} END AS Country_City_Match_{at}_{x}" for x in ("City_JW", "Country_JW")]
        flags += [f"{prefix}_Match", f"Country_City_Match_{at}"]
    names = [x.rsplit(" AS ", 1)[-1].split(".")[-1] for x in columns]
    empty = ", ".join("id" if x == "Input_ID" else "0" if x in flags else "NULL" for x in names)
    combos = " UNION ".join(f"SELECT Input_Record_ID, SDN_UID FROM g_{p[0]}" for p in parts)
    return f"WITH {FOUND}, {', '.join(views)}, c AS ({combos}) SELECT {', '.join(columns)} FROM c{joins} LEFT JOIN best ON best.Input_Record_ID = c.Input_Record_ID AND best.SDN_UID = c.SDN_UID UNION ALL SELECT {empty} FROM unmatched"


_FNLN = {"FN_JW": "FirstName_JaroWinklerSimilarity", "LN_JW": "LastName_JaroWinklerSimilarity"}
_JW = {"JW": "FullName_JaroWinklerSimilarity"}
_PERSON_NAMES = ("concat_ws(' ', SourceFN, SourceLN)", "concat_ws(' ', SDNFN, SDNLN)")
X10 = summary([("Person_Regular", "Person", "m", _FNLN, *_PERSON_NAMES), ("Person_aka", "Person_aka", "n", _FNLN, *_PERSON_NAMES), ("Person_LinkedTo", "Person_Linked_To", "(SELECT * FROM lt WHERE Input_Name_Form <> 'EntityName')", _JW, "SourceName", "LinkedTo_Text")])
X11 = summary([("Org", "Org", "o", _JW, "SourceOrgName", "SDNOrgName"), ("Org_aka", "Org_Aka", "q", _JW, "SourceOrgName", "SDNOrgName"), ("Org_LinkedTo", "Org_LinkedTo", "(SELECT * FROM lt WHERE Input_Name_Form = 'EntityName')", _JW, "SourceName", "LinkedTo_Text")])

_REPORT = ("Input_Record_ID", "SDN_UID", "Match_Type", "Input_Name", "SDN_Name", "FirstName_JW", "LastName_JW", "FullName_JW", "AKA_UID", "AKA_Category", "LinkedTo_Text", "Input_Phone", "SDN_Phone", "SDN_Type")


def _branch(source: str, kind: str, **given: str) -> str:
    given = {"Input_Record_ID": "Input_Record_ID", "SDN_UID": "SDN_UID", "Match_Type": f"'{kind}'", **given}
    return "SELECT " + ", ".join(f"{given.get(c, 'NULL')} AS {c}" for c in _REPORT) + f" FROM {source}"


_NAMES = {"Input_Name": "SourceFN || ' ' || SourceLN", "SDN_Name": "SDNFN || ' ' || SDNLN", "FirstName_JW": "FirstName_JaroWinklerSimilarity", "LastName_JW": "LastName_JaroWinklerSimilarity"}
_AKA = {"AKA_UID": "AKA_UID", "AKA_Category": "AKA_Category"}
_COMPANY = {"Input_Name": "SourceOrgName", "SDN_Name": "SDNOrgName", "FullName_JW": "FullName_JaroWinklerSimilarity", "SDN_Type": "SDN_Type"}
_HIGH = "FullName_JaroWinklerSimilarity >= 85"
X13 = f"""WITH {FOUND}, rows AS ({" UNION ALL ".join((
    _branch("m", "Person_Name", SDN_Type="SDN_Type", **_NAMES), _branch("n", "Person_AKA", **_NAMES, **_AKA), _branch(f"o WHERE {_HIGH}", "Org_Name", **_COMPANY), _branch(f"q WHERE {_HIGH}", "Org_AKA", **_COMPANY, **_AKA),
    _branch(f"lt WHERE {_HIGH}", "LinkedTo", Input_Name="SourceName", SDN_Name="LinkedTo_Text", FullName_JW="FullName_JaroWinklerSimilarity", LinkedTo_Text="LinkedTo_Text"),
    _branch("f", "Phone", Input_Name="Input_Phone_Raw", SDN_Name="SDN_Phone_Raw", FullName_JW="JaroWinkler_Digits", Input_Phone="Input_Phone_Raw", SDN_Phone="SDN_Phone_Raw"),
))}),
one AS (SELECT Input_Record_ID, SDN_UID, City_JaroWinklerSimilarity AS Country_City_Match, SourceCity AS Input_City, SDNCity AS SDN_City, SourceCountry AS Input_Country, SDNCountry AS SDN_Country FROM z WHERE City_JaroWinklerSimilarity > 70 AND Country_JaroWinklerSimilarity > 70
  QUALIFY row_number() OVER (PARTITION BY Input_Record_ID, SDN_UID ORDER BY City_JaroWinklerSimilarity DESC, SDNAddress_UID) = 1)
SELECT * FROM rows LEFT JOIN one USING (Input_Record_ID, SDN_UID)"""  # fmt: skip

# audit rows and scores

_PASSING = f"""names AS (
  SELECT Input_Record_ID, SDN_UID, NULL::BIGINT AS SDN_AKA_UID, 'Regular' AS SDN_Name_Type, SDNFN AS SDNCompareFN, SDNLN AS SDNCompareLN, FirstName_JaroWinklerSimilarity AS FN_JW, LastName_JaroWinklerSimilarity AS LN_JW, NULL::DOUBLE AS OrgNM_JW, NULL::INT AS SourceNumberofWords, NULL::INT AS SDNNumberofWords, NULL::INT AS WordNumberMatchingJaroWinkler FROM (WITH {PERSONS} {X1})
  UNION ALL SELECT Input_Record_ID, SDN_UID, AKA_UID, 'AKA', SDNFN, SDNLN, FirstName_JaroWinklerSimilarity, LastName_JaroWinklerSimilarity, NULL, NULL, NULL, NULL FROM (WITH {PERSONS} {X2})
  UNION ALL SELECT * FROM (WITH {ORGS} SELECT iid, CASE WHEN kind = 0 THEN wid ELSE wid - 1 END, CASE WHEN kind = 1 THEN wid END, CASE WHEN kind = 0 THEN 'Regular' ELSE 'AKA' END, NULL, wname, NULL, NULL, full_jw, src_words, sdn_words, matched FROM near JOIN s4 USING (a, b) WHERE {ENOUGH}))"""
_WHERE = "address1, city, region, postal_code, country"
_FULL = f"concat_ws(' ', nullif({address('address1')}, ''), nullif({nm('city')}, ''), nullif({state('region')}, ''), nullif({nm('postal_code')}, ''), nullif({country('country')}, ''))"
_PLACES4 = f"{_FULL} AS v_full, {country('country')} AS v_country, concat_ws(' ', nullif({nm('city')}, ''), nullif({country('country')}, '')) AS v_city, concat_ws(' ', nullif({state('region')}, ''), nullif({country('country')}, '')) AS v_region"
GATE_PASSING = f"""{_PASSING}, {PEOPLE}, {PARTS}, {PLACES},
given AS (SELECT doc_id AS id, 'Individual' AS kind, fn, ln, NULL AS en, c.*, {_PLACES4} FROM people LEFT JOIN (SELECT id AS cid, {_WHERE} FROM customers) c ON cid = doc_id WHERE doc_id % 5 >= 2
  UNION ALL SELECT p_partkey + {ORG_BASE}, 'Entity', NULL, NULL, name, NULL, NULL, NULL, NULL, NULL, NULL, '', '', '', '' FROM parts WHERE p_partkey % 97 > 1),
listed AS (SELECT id * 5 AS uid, id AS aid, {_WHERE}, {_PLACES4} FROM suppliers WHERE id * 5 IN (SELECT doc_id FROM people)),
x9 AS (SELECT n.*, NULL::VARCHAR AS Contact_ID, NULL::VARCHAR AS Entity_ID, g.kind AS Input_Type, g.fn AS InputFN, g.ln AS InputLN, g.en AS InputOrgNM, g.address1 AS InputStreetAddress, g.city AS InputCity, g.region AS InputRegion, g.postal_code AS InputPostalCode, g.country AS InputCountry,
  CASE WHEN n.SDN_UID >= {ORG_BASE} THEN 'Entity' ELSE 'Individual' END AS SDN_Type, a.aid AS SDN_Address_UID, a.address1 AS SDNStreetAddress, a.city AS SDNCity, a.region AS SDNRegion, a.postal_code AS SDNPostalCode, a.country AS SDNCountry,
  {", ".join(f"{jw(f'g.v_{x}', f"coalesce(a.v_{x}, '')")} AS {y}_JW" for x, y in (("full", "FullAddress"), ("country", "Country"), ("city", "CityCountry"), ("region", "RegionCountry")))}
  FROM names n JOIN given g ON g.id = n.Input_Record_ID LEFT JOIN listed a ON a.uid = n.SDN_UID)"""
X9 = f"WITH {GATE_PASSING} SELECT * FROM x9"

_W = tables.WEIGHTS


def _between(low: float, high: float, value: str, floor: float) -> str:
    return f"{low} + {high - low} * least(greatest({value} - {floor}, 0), {100 - floor}) / {100 - floor}"


def _any(x: str, y: str) -> str:
    return f"len([q_ FOR q_ IN {y} IF jaro_winkler_similarity({x}, q_) >= {_W['WordMatch_JW_Threshold'] / 100}]) > 0"


def _many(x: str, y: str) -> str:
    return f"len([p_ FOR p_ IN {x} IF {_any('p_', y)}])"


_TOKENS = f"[x_ FOR x_ IN string_split_regex(trim(lower({{}})), '\\s+') IF x_ <> '' AND NOT list_contains({list(tables.STOP_WORDS)}, x_)]"
_TIERS = [("CityCountry", "Address_CityCountry"), ("RegionCountry", "Address_RegionCountry"), ("Country", "Address_Country")]
#: The composite score: token categories of organisations, and the five parts.
X12 = f"""WITH {GATE_PASSING},
listed_names AS (SELECT doc_id AS nu, NULL::BIGINT AS na, fn || ' ' || ln AS nn, '' AS cat FROM people WHERE doc_id % 5 = 0 UNION ALL SELECT doc_id - 1, doc_id, fn || ' ' || ln, CASE WHEN doc_id % 2 = 0 THEN 'strong' ELSE 'weak' END FROM people WHERE doc_id % 5 = 1
  UNION ALL SELECT p_partkey + {ORG_BASE}, NULL, name, '' FROM parts WHERE p_partkey % 97 = 0 UNION ALL SELECT p_partkey + {ORG_BASE} - 1, p_partkey + {ORG_BASE}, name, CASE WHEN p_partkey % 2 = 0 THEN 'strong' ELSE 'weak' END FROM parts WHERE p_partkey % 97 = 1),
t0 AS (SELECT x9.*, cat, {_TOKENS.format("coalesce(InputOrgNM, '')")} AS ta, {_TOKENS.format("coalesce(nn, '')")} AS tb FROM x9 LEFT JOIN listed_names ON nu = SDN_UID AND na IS NOT DISTINCT FROM SDN_AKA_UID),
t1 AS (SELECT *, {_many("ta", "tb")} AS tn, {_many("tb", "ta")} AS tm, len(ta) > 1 AND len(tb) > 1 AND {_any("ta[1]", "tb")} AND {_any("ta[-1]", "tb")} AS ends, CASE WHEN len(tb) > 2 THEN {_many("tb[2:-2]", "ta")} / (len(tb) - 2) ELSE 1.0 END AS middle FROM t0),
t2 AS (SELECT *, CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 'None' WHEN tn = len(ta) AND tm = len(tb) THEN 'All' WHEN ends AND middle >= 0.5 THEN 'FirstLast' WHEN tn / greatest(len(ta), len(tb)) > 0.5 THEN 'Majority' WHEN tn > 0 THEN 'Minority' ELSE 'None' END AS category FROM t1),
t3 AS (SELECT *, 100 * CASE category WHEN 'FirstLast' THEN middle WHEN 'Majority' THEN tn / greatest(len(ta), len(tb)) WHEN 'Minority' THEN tn / greatest(len(ta), len(tb)) ELSE 1 END AS share FROM t2),
t4 AS (SELECT *, CASE WHEN Input_Type = 'Individual' THEN (coalesce(FN_JW, 0) + coalesce(LN_JW, 0)) / 2.0 / 100.0 * {_W["NameSimilarity_Max"]} ELSE CASE category WHEN 'All' THEN {_W["TokenMatch_All"]}
    WHEN 'FirstLast' THEN {_between(_W["TokenMatch_FirstLast_Min"], _W["TokenMatch_FirstLast_Max"], "share", 50)} WHEN 'Majority' THEN {_between(_W["TokenMatch_Majority_Min"], _W["TokenMatch_Majority_Max"], "share", 50)} WHEN 'Minority' THEN {_between(_W["TokenMatch_Minority_Min"], _W["TokenMatch_Minority_Max"], "share", 0)} ELSE 0 END + coalesce(OrgNM_JW, 0) / 100.0 * {_W["FuzzyMatch_Max"]} END AS p1,
  CASE WHEN SDN_Name_Type = 'Regular' THEN {_W["NameContext_Primary"]} WHEN cat = 'strong' THEN {_W["NameContext_StrongAKA"]} ELSE {_W["NameContext_WeakAKA"]} END::DOUBLE AS p2, CASE WHEN Input_Type = SDN_Type THEN {_W["EntityType_Match"]} ELSE 0 END::DOUBLE AS p3,
  CASE WHEN FullAddress_JW >= {_W["Address_JW_Threshold"]} THEN {_W["Address_Full"]} {" ".join(f"WHEN {c}_JW >= {_W['Address_JW_Threshold']} THEN {_between(_W[f'{w}_Min'], _W[f'{w}_Max'], f'{c}_JW', _W['Address_JW_Threshold'])}" for c, w in _TIERS)} ELSE 0 END::DOUBLE AS p4,
  CASE WHEN Country_JW >= 100 THEN {_W["Country_Full"]} ELSE 0 END::DOUBLE AS p5 FROM t3)
SELECT * EXCLUDE (cat, ta, tb, tn, tm, ends, middle, category, share, p1, p2, p3, p4, p5), round(p1::VARCHAR::DECIMAL(38, 18), 2)::DOUBLE AS Score_NameSimilarity, round(p2::VARCHAR::DECIMAL(38, 18), 2)::DOUBLE AS Score_NameContext, round(p3::VARCHAR::DECIMAL(38, 18), 2)::DOUBLE AS Score_EntityType, round(p4::VARCHAR::DECIMAL(38, 18), 2)::DOUBLE AS Score_Address, round(p5::VARCHAR::DECIMAL(38, 18), 2)::DOUBLE AS Score_Country,
  CASE WHEN Input_Type <> 'Individual' THEN category END AS Score_TokenMatchCategory, round(least(100, p1 + p2 + p3 + p4 + p5)::VARCHAR::DECIMAL(38, 18), 2)::DOUBLE AS MatchDisposition FROM t4"""
