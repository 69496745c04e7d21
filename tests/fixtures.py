"""Small hand-made inputs (FIXTURES.md §7) for operator tests."""

import json
from decimal import ROUND_HALF_UP, Decimal

# Fixed value: default XML namespace of load documents (IEC 62325-451-6); parsing ignores it.
XML_NS = "urn:iec62325.351:tc57wg16:451-6:generationloaddocument:3:0"


def load_xml(periods):
    """periods: list of (start or None, resolution or None, [quantity text or None])."""
    out = [f'<GL_MarketDocument xmlns="{XML_NS}">']
    for start, res, qtys in periods:
        out.append("<TimeSeries><Period>")
        if start is not None:
            out.append(f"<timeInterval><start>{start}</start><end>x</end></timeInterval>")
        if res is not None:
            out.append(f"<resolution>{res}</resolution>")
        for i, q in enumerate(qtys, 1):
            qx = "" if q is None else f"<quantity>{q}</quantity>"
            out.append(f"<Point><position>{i}</position>{qx}</Point>")
        out.append("</Period></TimeSeries>")
    out.append("</GL_MarketDocument>")
    return "".join(out)


def weather_payload(city, country, lat, lon, day, temps, hums, winds, precs, codes):
    hours = [f"{day}T{h:02d}:00" for h in range(len(temps))]
    return json.dumps({"city_name": city, "country": country, "latitude": lat, "longitude": lon,
                       "hourly": {"time": hours, "temperature_2m": temps, "relative_humidity_2m": hums,
                                  "wind_speed_10m": winds, "precipitation": precs,
                                  "weather_code": codes, "shortwave_radiation": [0.0] * len(temps)}})


# One invented day of weather (24 hours) and ten invented load hours.
SAMPLE_TEMPS = [round(4.0 + 0.9 * min(h, 24 - h) - 0.1 * (h % 3), 1) for h in range(24)]
SAMPLE_HUMS = [80 - 2 * min(h, 24 - h) + h % 2 for h in range(24)]
SAMPLE_WINDS = [round(9.5 + 0.7 * (h % 8), 1) for h in range(24)]
SAMPLE_CODES = [(0, 1, 2, 3)[h // 6] for h in range(24)]
SAMPLE_LOADS = [round(41000.25 + 1234.57 * h - 61.13 * h * h, 2) for h in range(10)]


def mean2(values):
    """Mean of printed values, rounded half up to two decimals."""
    total = sum(Decimal(str(v)) for v in values)
    return (total / len(values)).quantize(Decimal("0.01"), ROUND_HALF_UP)


def dec(value):
    return Decimal(str(value)).quantize(Decimal("0.01"), ROUND_HALF_UP)
