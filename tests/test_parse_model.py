"""Parsing against character-by-character models on random text."""

import datetime as dt
import random

from pyspark.sql import functions as F

from risklake.functions import parse

BLANK = " \t\n\x0b\f\r"


def scan_digits(text, i):
    j = i
    while j < len(text) and text[j] in "0123456789":
        j += 1
    return j


def model_integer(text):
    i = 0
    while i < len(text) and text[i] in BLANK:
        i += 1
    sign = i
    if i < len(text) and text[i] in "+-":
        i += 1
    end = scan_digits(text, i)
    if end == i:
        return 0
    return max(-(2**63), min(2**63 - 1, int(text[sign:end])))


def model_real(text):
    i = 0
    while i < len(text) and text[i] in BLANK:
        i += 1
    start = i
    if i < len(text) and text[i] in "+-":
        i += 1
    whole = scan_digits(text, i)
    end, digits = whole, whole - i
    if end < len(text) and text[end] == ".":
        fraction = scan_digits(text, end + 1)
        digits += fraction - end - 1
        end = fraction
    if not digits:
        return 0.0
    if end < len(text) and text[end] in "eE":
        i = end + 1
        if i < len(text) and text[i] in "+-":
            i += 1
        exponent = scan_digits(text, i)
        if exponent > i:
            end = exponent
    return float(text[start:end])


def model_millis(text):
    """Milliseconds of a strict ISO day, or of one with blanks or T, a clock and a zone."""
    try:
        if len(text) < 10 or not all(c in "0123456789" for c in text[:4] + text[5:7] + text[8:10]):
            return None
        if text[4] != "-" or text[7] != "-":
            return None
        if not 1 <= int(text[8:10]) <= 31:
            return None
        day = dt.datetime(int(text[:4]), int(text[5:7]), 1) + dt.timedelta(int(text[8:10]) - 1)
        rest = text[10:].lstrip(BLANK + "T")
        seconds = minutes = 0.0
        if rest:
            clock, zone = rest[:5], rest[5:]
            if len(clock) < 5 or clock[2] != ":" or not (clock[:2] + clock[3:]).isascii():
                return None
            if not (clock[:2] + clock[3:]).isdigit() or int(clock[:2]) > 24 or int(clock[3:]) > 59:
                return None
            if zone.startswith(":"):
                end = scan_digits(zone, 1)
                if end != 3 or int(zone[1:3]) > 59:
                    return None
                if zone[3:4] == "." and scan_digits(zone, 4) > 4:
                    end = scan_digits(zone, 4)
                seconds, zone = float(zone[1:end]), zone[end:]
            seconds += int(clock[:2]) * 3600 + int(clock[3:]) * 60
            zone = zone.strip(BLANK)
            if zone and zone not in "zZ":
                if len(zone) != 6 or zone[0] not in "+-" or zone[3] != ":":
                    return None
                if not (zone[1:3] + zone[4:]).isdigit() or int(zone[1:3]) > 14 or int(zone[4:]) > 59:
                    return None
                minutes = (int(zone[1:3]) * 60 + int(zone[4:])) * (-1 if zone[0] == "+" else 1)
        moment = day + dt.timedelta(seconds=seconds, minutes=minutes)
        return (moment - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1)
    except (ValueError, OverflowError):
        return None


def check(spark, texts, expression, model):
    df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, x string")
    got = [row[1] for row in df.select("i", expression(F.col("x"))).orderBy("i").collect()]
    wrong = [(text, value, model(text)) for text, value in zip(texts, got) if value != model(text)]
    assert not wrong, wrong[:10]


def test_random_numbers(spark):
    r = random.Random(11)
    texts = ["".join(r.choice("0123456789+-..eE ,\tx") for _ in range(r.randrange(0, 9))) for _ in range(20000)]
    texts += ["".join(r.choice("0123456789") for _ in range(r.randrange(15, 60))) for _ in range(500)]
    texts += [r.choice(["", "+", "-", " "]) + f"{r.randrange(10**r.randrange(1, 21))}{tail}" for tail in
              ["", ".5", "e2", ",1", "-", "d", "L", " 1"] for _ in range(100)]
    check(spark, texts, parse.to_integer, model_integer)
    check(spark, texts, parse.to_real, model_real)


def test_random_moments(spark):
    r = random.Random(12)
    days = ["2024-02-29", "2023-02-29", "1999-12-31", "2021-06-15", "2021-6-15", "2021-00-10", "1960-01-01"]
    gaps = ["", " ", "T", "  ", " T", "t", "\t"]
    clocks = ["", "10:30", "23:59", "24:00", "10:60", "1:30", "9"]
    clocks += ["00:00:00", "12:34:56", "12:34:56.789", "12:34:5", "12:34:61"]
    zones = ["", "Z", "z", " Z", "+02:00", "-03:30", " -11:00", "+2:00", "UTC", "+14:00", "+15:00", "-18:00"]
    ends = ["", " ", "\n", "x"]
    pick = [days, gaps, clocks, zones, ends]
    texts = sorted({"".join(r.choice(options) for options in pick) for _ in range(6000)})
    for _ in range(2000):  # a character changed
        text = r.choice(texts[: len(texts)]) or "2021-01-01"
        i = r.randrange(len(text))
        texts.append(text[:i] + r.choice("0123456789:-T Zx") + text[i + 1 :])
    check(spark, texts, parse.to_millis, model_millis)
