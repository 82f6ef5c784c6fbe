"""Fixed values of the domain.

Everything here has to equal what the published statistics use, so it is stated
as plain data.  The operators never import these directly: they take code sets
and seeds as arguments, and the jobs in ``tierwell.plans`` pass them in.
"""

import datetime

# --- fixed values: county code -> electricity price area ---------------------
COUNTY_PRICE_AREA = {
    "01": "SE3",
    "03": "SE3",
    "04": "SE3",
    "05": "SE3",
    "06": "SE3",
    "07": "SE4",
    "08": "SE4",
    "09": "SE3",
    "10": "SE4",
    "12": "SE4",
    "13": "SE4",
    "14": "SE3",
    "17": "SE3",
    "18": "SE3",
    "19": "SE3",
    "20": "SE3",
    "21": "SE2",
    "22": "SE2",
    "23": "SE2",
    "24": "SE2",
    "25": "SE1",
}

# --- fixed values: counties crossed by a price area border -------------------
SPLIT_COUNTIES = ("07", "08", "13", "20", "21")

# --- fixed values: region codes no longer in use ------------------------------
RETIRED_REGIONS = ("1917",)

# --- fixed values: fuel codes -------------------------------------------------
FUEL_CODES = ("100", "110", "120", "130", "140", "150", "160", "190")
FUEL_ELECTRIC = "120"
FUEL_PLUG_IN = "140"
ELECTRIFIED_FUELS = (FUEL_ELECTRIC, FUEL_PLUG_IN)

# --- fixed values: ownership codes --------------------------------------------
# 000 is the sum of 010, 020 and 030; 040 is part of 030; 050 and 060 are ratios.
OWNERSHIP_COUNTS = ("000", "010", "020", "030", "040")
OWNERSHIP_RATIOS = ("050", "060")
OWNERSHIP_TOTAL = "000"
OWNERSHIP_PARTS = ("010", "020", "030")
OWNERSHIP_LEGAL_ENTITY = "030"
OWNERSHIP_TAXI = "040"
OWNERSHIP_CARS_PER_1000 = "060"

# --- fixed values: price areas and their history ------------------------------
PRICE_AREAS = ("SE1", "SE2", "SE3", "SE4")
FIRST_PRICE_DATE = datetime.date(2022, 11, 1)
PRICE_GRACE_DAYS = 2
FIRST_STATISTICS_YEAR = 2016

# --- fixed values: periods a complete day may hold (normal and clock-change days)
COMPLETE_DAY_PERIODS = (23, 24, 25, 92, 96, 100)

# --- fixed values: limits used by the quality checks --------------------------
MUNICIPALITY_COUNT = 290
INHABITANTS_RANGE = (1_000, 1_500_000)
DAILY_PRICE_RANGE = (-5, 20)
DAILY_PRICE_ALERT = 6
MAX_MONTHS_BEHIND = 4
MAX_YEARS_BEHIND = 2
MAX_DAYS_BEHIND = 3

# --- fixed values: statistics tables, their target table and their dimensions --
CUBE_TABLES = {
    "scb_new_registrations": ("TAB3277", ("Region", "Drivmedel", "ContentsCode", "Tid")),
    "scb_cars_in_traffic": ("TAB3276", ("Region", "Agarkategori", "ContentsCode", "Tid")),
}
PRICE_TABLE = "electricity_prices"
PRICE_FOLDER = "elpris"

# --- fixed values: cube dimensions that carry a label next to the code --------
LABELLED_DIMENSIONS = ("Region", "Drivmedel", "Agarkategori")
