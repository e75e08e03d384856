"""Configuration of the analysis: countries, years, indicators, county and
sector filters, commodity labels and the event calendar.

The values below are fixed values: they must equal the source configuration
for results to line up, so they are stated plainly and in their natural order.
"""

from __future__ import annotations

# --- fixed values: countries (key -> iso3, trade reporter code) -------------
COUNTRIES = {
    "qatar": {"iso3": "QAT", "comtrade_code": "634"},
    "usa": {"iso3": "USA", "comtrade_code": "842"},
    "canada": {"iso3": "CAN", "comtrade_code": "124"},
    "mexico": {"iso3": "MEX", "comtrade_code": "484"},
}

# --- fixed values: year plan --------------------------------------------------
YEARS = {
    "qatar_training": [2019, 2020, 2021, 2022],
    "host_prediction": [2023, 2024, 2025],
    "worldbank": [2019, 2020, 2021, 2022, 2023, 2024, 2025],
    "cbp": [2019, 2021, 2022, 2023],
}

# --- fixed values: macro indicators (code -> friendly name) ------------------
INDICATORS = {
    "NY.GDP.PCAP.CD": "gdp_per_capita",
    "NE.TRD.GNFS.ZS": "trade_percent_gdp",
    "FP.CPI.TOTL.ZG": "inflation_percent",
    "SP.POP.TOTL": "population",
}

# --- fixed values: host counties (city, state, 5-digit county FIPS) ----------
HOST_COUNTIES = [
    ("New York", "NY", "36061"),
    ("Los Angeles", "CA", "06037"),
    ("Dallas", "TX", "48113"),
    ("San Francisco", "CA", "06075"),
    ("Seattle", "WA", "53033"),
    ("Kansas City", "MO", "29095"),
    ("Miami", "FL", "12086"),
    ("Atlanta", "GA", "13121"),
    ("Boston", "MA", "25025"),
    ("Philadelphia", "PA", "42101"),
    ("Houston", "TX", "48201"),
]

# --- fixed values: in-scope NAICS sectors (2-digit prefix -> group) ----------
NAICS_SECTORS = {
    "23": "Construction",
    "42": "Wholesale Trade",
    "44": "Retail Trade",
    "45": "Retail Trade",
    "48": "Transportation",
    "49": "Warehousing",
    "71": "Arts Entertainment Recreation",
    "72": "Accommodation Food Services",
}

# --- fixed values: HS2 chapter labels (97 entries, 77 and 98 absent) ---------
HS2_LABELS = {
    "01": "Live Animals", "02": "Meat", "03": "Fish", "04": "Dairy & Eggs",
    "05": "Animal Products", "06": "Plants", "07": "Vegetables", "08": "Fruit & Nuts",
    "09": "Coffee & Spices", "10": "Cereals", "11": "Milling Products",
    "12": "Oil Seeds", "13": "Gums & Resins", "14": "Vegetable Materials",
    "15": "Fats & Oils", "16": "Prepared Meat/Fish", "17": "Sugar",
    "18": "Cocoa", "19": "Cereal Preparations", "20": "Prepared Vegetables/Fruit",
    "21": "Misc. Food", "22": "Beverages", "23": "Food Industry Residues",
    "24": "Tobacco", "25": "Salt, Stone & Cement", "26": "Ores",
    "27": "Mineral Fuels", "28": "Inorganic Chemicals", "29": "Organic Chemicals",
    "30": "Pharmaceuticals", "31": "Fertilisers", "32": "Dyes & Paints",
    "33": "Perfumes & Cosmetics", "34": "Soap & Waxes", "35": "Proteins",
    "36": "Explosives", "37": "Photo Goods", "38": "Chemical Products",
    "39": "Plastics", "40": "Rubber", "41": "Raw Hides",
    "42": "Leather Goods", "43": "Furskins", "44": "Wood",
    "45": "Cork", "46": "Basketware", "47": "Pulp",
    "48": "Paper", "49": "Printed Books", "50": "Silk",
    "51": "Wool", "52": "Cotton", "53": "Vegetable Fibres",
    "54": "Man-made Filaments", "55": "Man-made Fibres", "56": "Wadding/Felt",
    "57": "Carpets", "58": "Special Fabrics", "59": "Coated Textiles",
    "60": "Knitted Fabrics", "61": "Knitted Clothing", "62": "Woven Clothing",
    "63": "Textile Articles", "64": "Footwear", "65": "Headgear",
    "66": "Umbrellas", "67": "Feathers", "68": "Stone/Cement Articles",
    "69": "Ceramics", "70": "Glass", "71": "Jewellery",
    "72": "Iron & Steel", "73": "Iron/Steel Articles", "74": "Copper",
    "75": "Nickel", "76": "Aluminium", "78": "Lead",
    "79": "Zinc", "80": "Tin", "81": "Other Metals",
    "82": "Tools", "83": "Metal Goods", "84": "Machinery",
    "85": "Electrical Machinery", "86": "Railway", "87": "Vehicles",
    "88": "Aircraft", "89": "Ships", "90": "Medical/Optical",
    "91": "Clocks", "92": "Musical Instruments", "93": "Arms",
    "94": "Furniture", "95": "Toys & Sports", "96": "Misc. Manufactures",
    "97": "Art & Antiques", "99": "Special Categories",
}

# --- fixed values: event calendar --------------------------------------------
EVENT_CALENDAR = [
    ("FIFA World Cup 2022", "QAT", "2022-11-20", "2022-05-20", "2021-11-20", "2021-05-20", "FIFA"),
    ("FIFA World Cup 2026", "USA", "2026-06-11", "2025-12-11", "2025-06-11", "2024-12-11", "FIFA"),
    ("FIFA World Cup 2026", "CAN", "2026-06-11", "2025-12-11", "2025-06-11", "2024-12-11", "FIFA"),
    ("FIFA World Cup 2026", "MEX", "2026-06-11", "2025-12-11", "2025-06-11", "2024-12-11", "FIFA"),
]

# --- fixed values: raw column aliases, first present wins --------------------
TRADE_RENAMES = {"cmdCode": "commodity_code", "cmdDesc": "commodity_desc"}
TRADE_VALUE_ALIASES = ["primaryValue", "TradeValue", "cifvalue", "fobvalue"]
ROLLUP_CODE = "TOTAL"

COUNTY_ROLES = {
    "state": ["STATE", "FIPSTATE", "STATEFP"],
    "county": ["COUNTY", "FIPCOUNTY", "FIPSCTY", "COUNTYFP"],
    "naics": ["NAICS2017", "NAICS2022", "NAICS"],
    "estab": ["ESTAB", "ESTABLISHMENTS", "EST"],
    "emp": ["EMP", "EMPLOYMENT"],
    "payann": ["PAYANN", "ANNUAL_PAYROLL", "AP"],
}
COUNTY_ROLE_NAMES = {
    "state": "STATE", "county": "COUNTY", "naics": "naics_code",
    "estab": "ESTAB", "emp": "EMP", "payann": "PAYANN",
}

# Defaults derived from the tables above.
BASELINE_ISO3 = COUNTRIES["qatar"]["iso3"]
TARGET_ISO3 = [COUNTRIES["usa"]["iso3"]]
HOST_ISO3 = [COUNTRIES[k]["iso3"] for k in ("usa", "canada", "mexico")]
GDP_INDICATOR = INDICATORS["NY.GDP.PCAP.CD"]
INDICATOR_NAMES = list(INDICATORS.values())


def trade_pull_plan() -> dict[str, list[int]]:
    """iso3 -> years pulled for trade (baseline training years, hosts' prediction years)."""
    plan = {BASELINE_ISO3: YEARS["qatar_training"]}
    for iso3 in HOST_ISO3:
        plan[iso3] = YEARS["host_prediction"]
    return plan
