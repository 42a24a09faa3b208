"""Fixed values that results depend on: normalization dictionaries and null words. Plain text, in natural order."""

# Words that stand for a missing value in matching (any case).
NULL_WORDS = ("nan", "none", "null")

# Words that blocking reads as missing (exact case).
NA_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Business designators, as matching contracts them.
NAME_WORDS = {
    "incorporated": "inc", "corporation": "corp", "limited": "ltd", "company": "co", "companies": "co", "association": "assoc",
    "university": "univ", "department": "dept", "international": "intl", "management": "mgmt", "services": "svcs", "service": "svcs",
    "group": "grp", "holdings": "hldg", "holding": "hldg", "private": "pvt", "technologies": "tech", "technology": "tech",
    "solutions": "soln", "enterprises": "ent", "enterprise": "ent", "center": "ctr", "centre": "ctr", "brothers": "bros",
}

# Trailing words that a root name drops.
ROOT_SUFFIXES = ("inc", "corp", "llc", "ltd", "co", "assoc", "pvt", "pllc", "pc", "sa", "gmbh", "bv", "ag", "sl", "srl", "spa", "lp", "llp")

# Address designators, as matching contracts them.
ADDRESS_WORDS = {
    "street": "st", "road": "rd", "avenue": "ave", "boulevard": "blvd", "drive": "dr", "lane": "ln", "court": "ct", "place": "pl",
    "circle": "cir", "parkway": "pkwy", "highway": "hwy", "freeway": "fwy", "square": "sq", "terrace": "ter", "trail": "trl", "way": "way",
    "suite": "ste", "apartment": "apt", "building": "bldg", "floor": "fl", "room": "rm", "department": "dept",
    "north": "n", "south": "s", "east": "e", "west": "w", "northeast": "ne", "northwest": "nw", "southeast": "se", "southwest": "sw",
}

# Country names that stand for a code.
COUNTRIES = {
    "united states": "us", "united states of america": "us", "usa": "us", "united kingdom": "gb", "great britain": "gb", "uk": "gb",
    "canada": "ca", "india": "in", "germany": "de", "deutschland": "de", "france": "fr", "australia": "au", "china": "cn",
    "japan": "jp", "brazil": "br", "mexico": "mx",
}

# Names of US states and territories, and their postal codes.
STATES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca", "colorado": "co", "connecticut": "ct",
    "delaware": "de", "florida": "fl", "georgia": "ga", "hawaii": "hi", "idaho": "id", "illinois": "il", "indiana": "in", "iowa": "ia",
    "kansas": "ks", "kentucky": "ky", "louisiana": "la", "maine": "me", "maryland": "md", "massachusetts": "ma", "michigan": "mi",
    "minnesota": "mn", "mississippi": "ms", "missouri": "mo", "montana": "mt", "nebraska": "ne", "nevada": "nv", "new hampshire": "nh",
    "new jersey": "nj", "new mexico": "nm", "new york": "ny", "north carolina": "nc", "north dakota": "nd", "ohio": "oh",
    "oklahoma": "ok", "oregon": "or", "pennsylvania": "pa", "rhode island": "ri", "south carolina": "sc", "south dakota": "sd",
    "tennessee": "tn", "texas": "tx", "utah": "ut", "vermont": "vt", "virginia": "va", "washington": "wa", "west virginia": "wv",
    "wisconsin": "wi", "wyoming": "wy", "district of columbia": "dc", "puerto rico": "pr",
}

# Legal words that blocking removes from names, wherever they stand.
BLOCK_LEGAL = ("incorporated", "inc", "corporation", "corp", "limited", "ltd", "private", "pvt", "llc", "llp", "company", "co", "plc")

# Address abbreviations, as blocking expands them.
BLOCK_ADDRESS = {
    "rd": "road", "st": "street", "ave": "avenue", "blvd": "boulevard", "dr": "drive", "ln": "lane", "hwy": "highway",
    "apt": "apartment", "bldg": "building", "flr": "floor", "nr": "near",
}
