"""Fixed values of the registry: names, ranges, weights and thresholds.

All of them are data that results depend on; nothing here is logic.
"""

# --- fixed values -----------------------------------------------------------

STATE_CODES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO",
    "connecticut": "CT", "delaware": "DE", "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID",
    "illinois": "IL", "indiana": "IN", "iowa": "IA", "kansas": "KS", "kentucky": "KY", "louisiana": "LA",
    "maine": "ME", "maryland": "MD", "massachusetts": "MA", "michigan": "MI", "minnesota": "MN",
    "mississippi": "MS", "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV",
    "new hampshire": "NH", "new jersey": "NJ", "new mexico": "NM", "new york": "NY", "north carolina": "NC",
    "north dakota": "ND", "ohio": "OH", "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA",
    "rhode island": "RI", "south carolina": "SC", "south dakota": "SD", "tennessee": "TN", "texas": "TX",
    "utah": "UT", "vermont": "VT", "virginia": "VA", "washington": "WA", "west virginia": "WV",
    "wisconsin": "WI", "wyoming": "WY", "district of columbia": "DC", "puerto rico": "PR", "guam": "GU",
    "american samoa": "AS", "u.s. virgin islands": "VI", "northern mariana islands": "MP",
}

#: upper-case state names of national layers that STATE_CODES lacks
LAYER_STATES = {"N. MARIANA ISLANDS": "MP", "PALAU": "PW", "VIRGIN ISLANDS": "VI", "FED. STATES": "FM", "MARSHALL ISLANDS": "MH"}
#: long names that national layers do not use
LAYER_UNUSED = ["u.s. virgin islands", "northern mariana islands"]

LAT_RANGE = (17.9, 71.4)
LON_RANGE = (-180.0, -64.5)

NAME_SUFFIXES = [
    "National Historic Landmark", "National Historic Site", "National Historical Park", "National Monument",
    "National Memorial", "National Battlefield", "National Military Park", "National Seashore",
    "National Lakeshore", "National Recreation Area", "National Preserve", "National Park", "Historic Site",
    "Historic District", "Historic Park", "NHL", "NHS", "NHP", "NM", "NMP", "NB",
]

#: slug, first year, last year (null: open)
ERAS = [
    ("pre-columbian", None, 1492), ("colonial", 1492, 1763), ("revolutionary", 1763, 1789),
    ("early-republic", 1789, 1830), ("antebellum", 1830, 1860), ("civil-war", 1861, 1865),
    ("reconstruction-gilded-age", 1865, 1900), ("progressive", 1900, 1917), ("interwar", 1918, 1940),
    ("wwii", 1941, 1945), ("postwar-cold-war", 1945, 1991), ("modern", 1991, None),
]
OPEN_START, OPEN_END = 0, 2026

#: area of significance, nature of events (null: none)
AREA_NATURES = [
    ("agriculture", "agricultural"), ("architecture", "architectural"), ("archaeology", None),
    ("art", "literary-artistic"), ("commerce", "economic-industrial"), ("communications", "science-technology"),
    ("community-planning", "cultural-societal"), ("conservation", "cultural-societal"),
    ("economics", "economic-industrial"), ("education", "educational"), ("engineering", "science-technology"),
    ("entertainment-recreation", "cultural-societal"), ("ethnic-heritage", "indigenous-heritage"),
    ("exploration-settlement", "exploration-settlement"), ("health-medicine", "science-technology"),
    ("industry", "economic-industrial"), ("invention", "science-technology"),
    ("landscape-architecture", "architectural"), ("law", "political"), ("literature", "literary-artistic"),
    ("maritime-history", "maritime"), ("military", "military"), ("performing-arts", "literary-artistic"),
    ("philosophy", "cultural-societal"), ("politics-government", "political"), ("religion", "religious"),
    ("science", "science-technology"), ("social-history", "civil-rights"), ("transportation", "transportation"),
    ("other", None),
]

#: name of an area of significance: slug
AREA_NAMES = {
    "Agriculture": "agriculture", "Architecture": "architecture", "Archaeology": "archaeology", "Art": "art",
    "Commerce": "commerce", "Communications": "communications", "Community Planning and Development": "community-planning",
    "Conservation": "conservation", "Economics": "economics", "Education": "education", "Engineering": "engineering",
    "Entertainment/Recreation": "entertainment-recreation", "Ethnic Heritage": "ethnic-heritage",
    "Exploration/Settlement": "exploration-settlement", "Health/Medicine": "health-medicine", "Industry": "industry",
    "Invention": "invention", "Landscape Architecture": "landscape-architecture", "Law": "law", "Literature": "literature",
    "Maritime History": "maritime-history", "Military": "military", "Performing Arts": "performing-arts",
    "Philosophy": "philosophy", "Politics/Government": "politics-government", "Religion": "religion",
    "Science": "science", "Social History": "social-history", "Transportation": "transportation", "Other": "other",
}

#: names that say nothing of a record in a state's survey
SURVEY_TERMS = [
    "house", "barn", "church", "school", "bridge", "store", "shed", "garage", "cabin", "mill", "office", "duplex",
    "outbuilding", "outbldg", "cemetery", "log house", "frame house", "log cabin", "commercial building",
    "commercial bldg", "frame building", "brick house", "stone house", "tobacco barn", "frame barn", "frame dwelling",
    "brick dwelling", "dwelling", "residence", "multiple dwelling", "single dwelling", "residential", "commercial",
    "industrial", "row houses", "row house", "rural survey property", "rural survey properties", "no name given",
    "no name property", "not named", "unnamed", "unknown", "not determined", "farm", "apartment building", "apartments",
    "single family", "multi-family", "business", "gas station", "warehouse", "factory",
]

#: designation: order, marker colour (an unknown one: last, gray)
DESIGNATIONS = {
    "Federal NHL": (1, "red"), "Federal NRHP": (2, "blue"), "NPS Unit": (3, "green"), "State Register": (4, "orange"),
    "Local Landmark": (5, "purple"), "Tribal": (6, "darkred"), "Private/NGO": (6, "cadetblue"),
}

GENERIC_NAMES = [
    "historic district", "historic site", "historic building", "site", "building", "district", "house", "church",
    "school", "bridge", "cemetery", "fort", "park", "monument",
]

SCORE_WEIGHTS = {
    "data_completeness": 0.10, "description_richness": 0.10, "official_data": 0.15, "nomination_extraction": 0.10,
    "ai_confidence": 0.25, "classification_ambiguity": 0.10, "source_agreement": 0.10, "name_specificity": 0.10,
}
AUTO_APPROVE, FLAG_BELOW = 0.8, 0.5

KEY_FIELDS = ["latitude", "longitude", "state", "address", "city", "date_constructed", "nhl_designation_date"]
SOURCE_FLAGS = ["source_arcgis", "source_spreadsheet", "source_nps_parks", "source_nomination", "source_shpo", "source_other"]

#: pattern, abbreviation, in the order they apply
ADDRESS_WORDS = [
    ("street", "st"), ("avenue", "ave"), ("boulevard", "blvd"), ("drive", "dr"), ("road", "rd"), ("lane", "ln"),
    ("court", "ct"), ("place", "pl"), ("north", "n"), ("south", "s"), ("east", "e"), ("west", "w"),
]

CELL_DEGREES = 0.05
EARTH_KM = 6371.0
NEAR_KM = 0.5
SCORE_CANDIDATE, SCORE_MATCH, SCORE_NAME_ONLY, SCORE_ANYWHERE = 70, 85, 90, 95

# --- end of fixed values ----------------------------------------------------
