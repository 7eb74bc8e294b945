"""Values that results depend on."""

from __future__ import annotations

# Postal codes of states and territories.
STATES = dict(
    AL="ALABAMA", AK="ALASKA", AZ="ARIZONA", AR="ARKANSAS", CA="CALIFORNIA", CO="COLORADO", CT="CONNECTICUT", DE="DELAWARE", FL="FLORIDA", GA="GEORGIA",
    HI="HAWAII", ID="IDAHO", IL="ILLINOIS", IN="INDIANA", IA="IOWA", KS="KANSAS", KY="KENTUCKY", LA="LOUISIANA", ME="MAINE", MD="MARYLAND",
    MA="MASSACHUSETTS", MI="MICHIGAN", MN="MINNESOTA", MS="MISSISSIPPI", MO="MISSOURI", MT="MONTANA", NE="NEBRASKA", NV="NEVADA", NH="NEW HAMPSHIRE", NJ="NEW JERSEY",
    NM="NEW MEXICO", NY="NEW YORK", NC="NORTH CAROLINA", ND="NORTH DAKOTA", OH="OHIO", OK="OKLAHOMA", OR="OREGON", PA="PENNSYLVANIA", RI="RHODE ISLAND", SC="SOUTH CAROLINA",
    SD="SOUTH DAKOTA", TN="TENNESSEE", TX="TEXAS", UT="UTAH", VT="VERMONT", VA="VIRGINIA", WA="WASHINGTON", WV="WEST VIRGINIA", WI="WISCONSIN", WY="WYOMING",
    DC="DISTRICT OF COLUMBIA", PR="PUERTO RICO", GU="GUAM", VI="VIRGIN ISLANDS", AS="AMERICAN SAMOA", MP="NORTHERN MARIANA ISLANDS",
)

# Country codes that are written out.
COUNTRIES = dict(
    US="UNITED STATES", USA="UNITED STATES", GB="UNITED KINGDOM", UK="UNITED KINGDOM", CA="CANADA", AU="AUSTRALIA", NZ="NEW ZEALAND", DE="GERMANY", FR="FRANCE", IT="ITALY",
    ES="SPAIN", PT="PORTUGAL", NL="NETHERLANDS", BE="BELGIUM", CH="SWITZERLAND", AT="AUSTRIA", SE="SWEDEN", NO="NORWAY", DK="DENMARK", FI="FINLAND",
    IE="IRELAND", PL="POLAND", CZ="CZECH REPUBLIC", RU="RUSSIA", CN="CHINA", JP="JAPAN", KR="SOUTH KOREA", IN="INDIA", MX="MEXICO", BR="BRAZIL",
    AR="ARGENTINA", SA="SAUDI ARABIA", AE="UNITED ARAB EMIRATES", IL="ISRAEL", TR="TURKEY", EG="EGYPT", ZA="SOUTH AFRICA", NG="NIGERIA", KE="KENYA", IR="IRAN",
    IQ="IRAQ", SY="SYRIA", LB="LEBANON", JO="JORDAN", KW="KUWAIT", QA="QATAR", BH="BAHRAIN", OM="OMAN", YE="YEMEN", PK="PAKISTAN",
    AF="AFGHANISTAN", UA="UKRAINE", BY="BELARUS", KZ="KAZAKHSTAN", AZ="AZERBAIJAN", GE="GEORGIA", AM="ARMENIA", UZ="UZBEKISTAN", CU="CUBA", VE="VENEZUELA",
    CO="COLOMBIA", PE="PERU", CL="CHILE", EC="ECUADOR", BO="BOLIVIA", PY="PARAGUAY", UY="URUGUAY", PA="PANAMA", CR="COSTA RICA", GT="GUATEMALA",
    HN="HONDURAS", NI="NICARAGUA", SV="EL SALVADOR", DO="DOMINICAN REPUBLIC", HT="HAITI", LY="LIBYA", MA="MOROCCO", DZ="ALGERIA", TN="TUNISIA", SD="SUDAN",
    SO="SOMALIA", ET="ETHIOPIA", CD="DEMOCRATIC REPUBLIC OF THE CONGO", SG="SINGAPORE", MY="MALAYSIA", ID="INDONESIA", TH="THAILAND", VN="VIETNAM", PH="PHILIPPINES", MM="MYANMAR",
    BD="BANGLADESH", LK="SRI LANKA", NP="NEPAL", HK="HONG KONG", TW="TAIWAN",
)

# Forms of organisations, as abbreviation, expanded form and position.
ENTITY_TYPES = [
    ("LLC", "Limited Liability Company", "BOTH"), ("LC", "Limited Company", "SUFFIX"), ("INC", "Incorporated", "SUFFIX"), ("CORP", "Corporation", "SUFFIX"), ("LTD", "Limited", "SUFFIX"),
    ("LP", "Limited Partnership", "SUFFIX"), ("LLP", "Limited Liability Partnership", "SUFFIX"), ("LLLP", "Limited Liability Limited Partnership", "SUFFIX"), ("PC", "Professional Corporation", "SUFFIX"),
    ("PLLC", "Professional Limited Liability Company", "SUFFIX"), ("PA", "Professional Association", "SUFFIX"), ("PLC", "Public Limited Company", "SUFFIX"), ("CO", "Company", "SUFFIX"),
    ("ASSOC", "Association", "SUFFIX"), ("ASSN", "Association", "SUFFIX"), ("BROS", "Brothers", "SUFFIX"), ("INTL", "International", "SUFFIX"), ("NATL", "National", "SUFFIX"),
    ("MGMT", "Management", "SUFFIX"), ("SVCS", "Services", "SUFFIX"), ("SVC", "Service", "SUFFIX"), ("TECH", "Technology", "SUFFIX"),
    ("GMBH", "Gesellschaft mit Beschraenkter Haftung", "SUFFIX"), ("AG", "Aktiengesellschaft", "SUFFIX"), ("KG", "Kommanditgesellschaft", "SUFFIX"), ("OHG", "Offene Handelsgesellschaft", "SUFFIX"),
    ("UG", "Unternehmergesellschaft", "SUFFIX"), ("EV", "Eingetragener Verein", "SUFFIX"), ("SA", "Societe Anonyme", "SUFFIX"), ("SARL", "Societe a Responsabilite Limitee", "SUFFIX"),
    ("SAS", "Societe par Actions Simplifiee", "SUFFIX"), ("SNC", "Societe en Nom Collectif", "SUFFIX"), ("SC", "Societe Civile", "SUFFIX"), ("SPA", "Societa per Azioni", "SUFFIX"),
    ("SRL", "Societa a Responsabilita Limitata", "SUFFIX"), ("SL", "Sociedad Limitada", "SUFFIX"), ("LTDA", "Limitada", "SUFFIX"), ("LDA", "Limitada", "SUFFIX"),
    ("BV", "Besloten Vennootschap", "SUFFIX"), ("NV", "Naamloze Vennootschap", "SUFFIX"), ("VOF", "Vennootschap onder Firma", "SUFFIX"), ("CV", "Commanditaire Vennootschap", "SUFFIX"),
    ("AB", "Aktiebolag", "SUFFIX"), ("AS", "Aksjeselskap", "SUFFIX"), ("OY", "Osakeyhtioe", "SUFFIX"), ("BHD", "Berhad", "SUFFIX"), ("KK", "Kabushiki Kaisha", "SUFFIX"), ("GK", "Godo Kaisha", "SUFFIX"),
    ("OAO", "Otkrytoye Aktsionernoye Obshchestvo", "BOTH"), ("ZAO", "Zakrytoye Aktsionernoye Obshchestvo", "BOTH"), ("OOO", "Obshchestvo s Ogranichennoy Otvetstvennostyu", "BOTH"),
    ("PAO", "Publichnoye Aktsionernoye Obshchestvo", "BOTH"), ("AO", "Aktsionernoye Obshchestvo", "BOTH"), ("WLL", "With Limited Liability", "SUFFIX"), ("BSC", "Bahraini Shareholding Company", "SUFFIX"),
    ("KSC", "Kuwaiti Shareholding Company", "SUFFIX"), ("KSCC", "Kuwaiti Shareholding Company Closed", "SUFFIX"), ("PSC", "Private Shareholding Company", "SUFFIX"), ("JSC", "Joint Stock Company", "BOTH"),
    ("OJSC", "Open Joint Stock Company", "BOTH"), ("CJSC", "Closed Joint Stock Company", "BOTH"), ("PJSC", "Public Joint Stock Company", "BOTH"),
]

# Street words as abbreviation and full form; + marks those that also have a plural, with an s more on either side.
_STREETS = """
Aly Alley, Anx Annex, Arc Arcade, Ave Avenue, Byu Bayou, Bch Beach, Bnd Bend, Blf+ Bluff, Btm Bottom, Blvd Boulevard, Br Branch, Brg Bridge, Brk+ Brook, Bg+ Burg, Byp Bypass, Cp Camp, Cyn Canyon, Cpe Cape,
Cswy Causeway, Ctr+ Center, Cir+ Circle, Clf+ Cliff, Clb Club, Cmn+ Common, Cor+ Corner, Crse Course, Ct+ Court, Cv+ Cove, Crk Creek, Cres Crescent, Crst Crest, Xing Crossing, Xrd+ Crossroad, Curv Curve, Dl Dale,
Dm Dam, Dv Divide, Dr+ Drive, Est+ Estate, Expy Expressway, Ext+ Extension, Fall Fall, Fls Falls, Fry Ferry, Fld+ Field, Flt+ Flat, Frd+ Ford, Frst Forest, Frg+ Forge, Frk+ Fork, Ft Fort, Fwy Freeway, Gdn+ Garden,
Gtwy Gateway, Gln+ Glen, Grn+ Green, Grv+ Grove, Hbr+ Harbor, Hvn Haven, Hts Heights, Hwy Highway, Hl+ Hill, Holw Hollow, Inlt Inlet, Is+ Island, Isle Isle, Jct+ Junction, Ky+ Key, Knl+ Knoll, Lk+ Lake, Land Land,
Lndg Landing, Ln Lane, Lgt+ Light, Lf Loaf, Lck+ Lock, Ldg Lodge, Loop Loop, Mall Mall, Mnr+ Manor, Mdw+ Meadow, Mews Mews, Ml+ Mill, Msn Mission, Mtwy Motorway, Mt Mount, Mtn+ Mountain, Nck Neck, Orch Orchard,
Oval Oval, Opas Overpass, Park Park, Pkwy Parkway, Pass Pass, Psge Passage, Path Path, Pike Pike, Pne+ Pine, Pl Place, Pln+ Plain, Plz Plaza, Pt+ Point, Prt+ Port, Pr Prairie, Radl Radial, Ramp Ramp, Rnch Ranch,
Rpd+ Rapid, Rst Rest, Rdg+ Ridge, Riv River, Rd+ Road, Rte Route, Row Row, Rue Rue, Run Run, Shl+ Shoal, Shr+ Shore, Skwy Skyway, Spg+ Spring, Spur Spur, Sq+ Square, Sta Station, Stra Stravenue, Strm Stream,
St+ Street, Smt Summit, Ter Terrace, Trwy Throughway, Trce Trace, Trak Track, Trfy Trafficway, Trl Trail, Tunl Tunnel, Tpke Turnpike, Upas Underpass, Un+ Union, Vly+ Valley, Via Viaduct, Vw+ View, Vlg+ Village,
Vl Ville, Vis Vista, Walk Walk, Wls Wells, Wy Way, Ways Ways
"""
# Directions, units, and words that mean something else at the beginning of a line.
_OTHERS = """
N North, S South, E East, W West, NE Northeast, NW Northwest, SE Southeast, SW Southwest,
Apt Apartment, Bldg Building, Dept Department, Fl Floor, Frnt Front, Hngr Hangar, Key Key, Lbby Lobby, Lot Lot, Lowr Lower, Ofc Office, Ph Penthouse, Pier Pier, Rear Rear, Rm Room, Side Side, Slip Slip, Spc Space,
Stop Stop, Ste Suite, Trlr Trailer, Unit Unit, Uppr Upper, St Saint, Mt Mount, Ft Fort
"""
_ONES = "First Second Third Fourth Fifth Sixth Seventh Eighth Ninth Tenth Eleventh Twelfth Thirteenth Fourteenth Fifteenth Sixteenth Seventeenth Eighteenth Nineteenth".split()
_TENS = "Twenty Thirty Forty Fifty Sixty Seventy Eighty Ninety".split()


def ordinal(n: int) -> tuple[str, str]:
    """1 to 200 as 21st and Twenty First."""
    tail = "th" if n % 100 in (11, 12, 13) else {1: "st", 2: "nd", 3: "rd"}.get(n % 10, "th")
    hundreds, rest = divmod(n, 100)
    words = [] if not hundreds else [("One", "Two")[hundreds - 1], "Hundred" if rest else "Hundredth"]
    if 0 < rest < 20:
        words.append(_ONES[rest - 1])
    elif rest:
        tens = _TENS[rest // 10 - 2]
        words += [tens, _ONES[rest % 10 - 1]] if rest % 10 else [tens[:-1] + "ieth"]
    return f"{n}{tail}", " ".join(words)


def _pairs(listed: str) -> list[tuple[str, str]]:
    return [tuple(x.split()) for x in listed.replace("\n", " ").split(",")]


def _address_abbreviations() -> list[tuple[str, str, int]]:
    streets = [x for a, b in _pairs(_STREETS) for x in ([(a[:-1], b), (f"{a[:-1]}s", f"{b}s")] if a.endswith("+") else [(a, b)])]
    return [("#", "Number", 0), *((a, b, 1) for a, b in streets), *((a, b, 0) for a, b in _pairs(_OTHERS)), *((*ordinal(n), 0) for n in range(1, 201))]


#: Address abbreviations, as abbreviation, full form, and 1 where it is not meant at the beginning. sources.lookups.abbreviations() reads others.
ADDRESS_ABBREVIATIONS = _address_abbreviations()

# Parts of countries, as country, kind, and code, code of the land's own (two digits) and name of each.
CHILD_JURISDICTIONS = {
    ("United States", "State"): """
AL 01 Alabama, AK 02 Alaska, AZ 04 Arizona, AR 05 Arkansas, CA 06 California, CO 08 Colorado, CT 09 Connecticut, DE 10 Delaware, FL 12 Florida, GA 13 Georgia, HI 15 Hawaii, ID 16 Idaho, IL 17 Illinois, IN 18 Indiana,
IA 19 Iowa, KS 20 Kansas, KY 21 Kentucky, LA 22 Louisiana, ME 23 Maine, MD 24 Maryland, MA 25 Massachusetts, MI 26 Michigan, MN 27 Minnesota, MS 28 Mississippi, MO 29 Missouri, MT 30 Montana, NE 31 Nebraska, NV 32 Nevada,
NH 33 New Hampshire, NJ 34 New Jersey, NM 35 New Mexico, NY 36 New York, NC 37 North Carolina, ND 38 North Dakota, OH 39 Ohio, OK 40 Oklahoma, OR 41 Oregon, PA 42 Pennsylvania, RI 44 Rhode Island, SC 45 South Carolina,
SD 46 South Dakota, TN 47 Tennessee, TX 48 Texas, UT 49 Utah, VT 50 Vermont, VA 51 Virginia, WA 53 Washington, WV 54 West Virginia, WI 55 Wisconsin, WY 56 Wyoming
""",
    ("United States", "Territory"): "DC 11 District of Columbia, AS 60 American Samoa, GU 66 Guam, MP 69 Northern Mariana Islands, PR 72 Puerto Rico, VI 78 U.S. Virgin Islands",
    ("Canada", "Province"): "AB - Alberta, BC - British Columbia, MB - Manitoba, NB - New Brunswick, NL - Newfoundland and Labrador, NS - Nova Scotia, ON - Ontario, PE - Prince Edward Island, QC - Quebec, SK - Saskatchewan",
    ("Canada", "Territory"): "NT - Northwest Territories, NU - Nunavut, YT - Yukon",
}


def child_jurisdictions() -> list[tuple[str, str, str, str, str | None]]:
    """Jurisdiction, Abbreviation, Juris_Type, Parent and FIPS."""
    rows = []
    for (parent, kind), listed in CHILD_JURISDICTIONS.items():
        for x in listed.replace("\n", " ").split(","):
            code, fips, name = x.split(maxsplit=2)
            rows.append((name.strip(), code, kind, parent, None if fips == "-" else fips))
    return rows


# Words that do not count in the names of organisations.
STOP_WORDS = ("for", "and", "nor", "but", "or", "yet", "so", "the", "a", "an")

# Countries looked for at the end of a one-line address, the first listed that fits.
ADDRESS_COUNTRIES = (
    "United States", "United Kingdom", "Canada", "Singapore", "Guernsey", "Jersey", "Cayman Islands", "British Virgin Islands", "Germany",
    "France", "Netherlands", "Luxembourg", "Switzerland", "Australia", "Japan", "China", "Hong Kong", "Ireland",
)

# The orders in which the lines of a listed address are tried, from id 17 on; 32 is no match.
STREET_ORDERS = ((1, 2, 3), (1, 3, 2), (2, 3, 1), (2, 1, 3), (3, 1, 2), (3, 2, 1), (1, 2), (2, 1), (1, 3), (3, 1), (2, 3), (3, 2), (1,), (2,), (3,))
FIRST_STREET_ID, NO_STREET_ID = 17, 32

# Weights of the composite score.
WEIGHTS = {
    "NameSimilarity_Max": 45, "TokenMatch_All": 30, "TokenMatch_FirstLast_Min": 24, "TokenMatch_FirstLast_Max": 27, "TokenMatch_Majority_Min": 15, "TokenMatch_Majority_Max": 22.5,
    "TokenMatch_Minority_Min": 7.5, "TokenMatch_Minority_Max": 13.5, "FuzzyMatch_Max": 15, "NameContext_Primary": 15, "NameContext_StrongAKA": 12, "NameContext_WeakAKA": 6, "EntityType_Match": 15,
    "Address_Full": 15, "Address_CityCountry_Min": 10, "Address_CityCountry_Max": 12, "Address_RegionCountry_Min": 6, "Address_RegionCountry_Max": 9, "Address_Country_Min": 3, "Address_Country_Max": 5,
    "Address_JW_Threshold": 85, "Country_Full": 10, "WordMatch_JW_Threshold": 75,
}
