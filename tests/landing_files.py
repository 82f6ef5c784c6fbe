"""Generated landing files: a small country with 290 municipalities."""

import datetime
import json

from tierwell.functions import codes as C

COUNTIES = sorted(C.COUNTY_PRICE_AREA)
MUNICIPALITIES = [f"{COUNTIES[i % len(COUNTIES)]}{50 + i // len(COUNTIES):02d}" for i in range(C.MUNICIPALITY_COUNT)]
REGIONS = ["00", *COUNTIES, *MUNICIPALITIES, "1917"]
CATEGORIES = [*C.OWNERSHIP_COUNTS, *C.OWNERSHIP_RATIOS]


def region_label(code, suffix=""):
    return f"{'Riket' if code == '00' else 'Län' if len(code) == 2 else 'Kommun'} {code}{suffix}"


def category(codes, labels=None, as_object=False):
    index = {code: position for position, code in reversed(list(enumerate(codes)))} if as_object else list(codes)
    return {"category": {"index": index, "label": labels or {code: code for code in codes}}}


def document(axes, value):
    """``axes`` is [(id, dimension)], ``value`` a list or a dict of positions."""
    sizes = [len(dimension["category"]["index"]) for _, dimension in axes]
    return {"id": [name for name, _ in axes], "size": sizes, "dimension": dict(axes), "value": value}


def registration_count(region, fuel, period):
    return (int(region[-2:]) + int(fuel) + int(period[-2:])) % 50


def registrations(period, suffix="", as_object=False, change=None):
    cells = [registration_count(r, f, period) for r in REGIONS for f in C.FUEL_CODES]
    if change:
        region, fuel, count = change
        cells[REGIONS.index(region) * len(C.FUEL_CODES) + C.FUEL_CODES.index(fuel)] = count
    value = {str(i): n for i, n in enumerate(cells)} if as_object else cells
    return document([
        ("Region", category(REGIONS, {r: region_label(r, suffix) for r in REGIONS}, as_object)),
        ("Drivmedel", category(C.FUEL_CODES, {f: f"bränsle {f}" for f in C.FUEL_CODES})),
        ("ContentsCode", category(["TK1001AA"])),
        ("Tid", category([period])),
    ], value)


def cars(year):
    def of(region, code):
        women = 400 + int(region[-2:])
        return {"000": 3 * women, "010": women, "020": women, "030": women, "040": 7, "050": 300, "060": 412}[code]

    return document([
        ("Region", category(REGIONS, {r: region_label(r) for r in REGIONS})),
        ("Agarkategori", category(CATEGORIES, {c: f"kategori {c}" for c in CATEGORIES})),
        ("ContentsCode", category(["TK1001AB"])),
        ("Tid", category([str(year)])),
    ], [of(r, c) for r in REGIONS for c in CATEGORIES])


def price_day(area, day, periods=24, price=0.5):
    step = 24 * 60 // periods
    return [
        {
            "SEK_per_kWh": round(price + i / 100, 2), "EUR_per_kWh": 0.05, "EXR": 10.9,
            "time_start": f"{day}T{i * step // 60:02d}:{i * step % 60:02d}:00+01:00",
            "time_end": f"{day}T{((i + 1) * step // 60) % 24:02d}:{(i + 1) * step % 60:02d}:00+01:00",
        }
        for i in range(periods)
    ]


def write(path, payload):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(payload, ensure_ascii=False), encoding="utf-8")


def write_price(root, area, day, **how):
    write(root / "elpris" / f"elomrade={area}" / f"ar={day.year}" / f"{day.isoformat()}.json", price_day(area, day, **how))


def land(root, as_of, periods=("2022M08", "2022M09", "2022M10"), years=(2020, 2021)):
    for number, period in enumerate(periods):
        write(root / "TAB3277" / f"TAB3277_{period}.json", registrations(period, as_object=number % 2 == 1))
    for year in years:
        write(root / "TAB3276" / f"TAB3276_{year}.json", cars(year))
    day = C.FIRST_PRICE_DATE
    while day <= as_of:
        for area in C.PRICE_AREAS:
            write_price(root, area, day, periods=96 if area == "SE4" else 24)
        day += datetime.timedelta(days=1)
