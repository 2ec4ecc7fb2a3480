"""Randomised agreement with the Python standard library on the two parsers whose
rules are easy to get subtly wrong: lenient base64 and ISO-8601 event times."""

import base64
import json
import binascii
import datetime as dt
import random

from pyspark.sql import functions as F

from earshot.functions import ingest as X

JUNK = "!*# \n\r\t-_.~"


def py_b64(s):
    try:
        return base64.b64decode(s)          # lenient: foreign characters skipped
    except (binascii.Error, ValueError):
        return None


def test_base64_agrees_with_stdlib(spark):
    rnd = random.Random(7)
    cases = []
    for _ in range(400):
        raw = bytes(rnd.randrange(256) for _ in range(rnd.randrange(0, 60)))
        s = base64.b64encode(raw).decode()
        kind = rnd.randrange(7)
        if kind == 1:           # foreign characters sprinkled in
            for _ in range(rnd.randrange(1, 4)):
                i = rnd.randrange(len(s) + 1)
                s = s[:i] + rnd.choice(JUNK) + s[i:]
        elif kind == 2 and s.endswith("="):   # padding cut
            s = s[:-1]
        elif kind == 3 and len(s) > 2:        # a character lost
            i = rnd.randrange(len(s))
            s = s[:i] + s[i + 1:]
        elif kind in (4, 5):                  # padding where it doesn't belong, data after padding
            for _ in range(rnd.randrange(1, 4)):
                i = rnd.randrange(len(s) + 1)
                s = s[:i] + rnd.choice(["=", "==", "===", "Q=", "YQ=="]) + s[i:]
        elif kind == 6:
            s += rnd.choice(["=", "==", "x", "YQ==", "YWJj"])
        cases.append(s)
    df = spark.createDataFrame([(s,) for s in cases], "data string")
    got = df.select("data", X.decode_clean_base64(X.b64_clean(F.col("data"))).alias("b")).collect()
    for r in got:
        want = py_b64(r.data)
        have = None if r.b is None else bytes(r.b)
        assert have == want, (r.data, have, want)


def iso_cases(rnd):
    out = []
    for _ in range(400):
        y = rnd.choice([2023, 2024, 1999])
        m = rnd.choice([1, 2, 6, 12, 13, 0])
        d = rnd.choice([1, 15, 28, 29, 30, 31, 32])
        s = f"{y:04d}-{m:02d}-{d:02d}"
        if rnd.random() < 0.8:
            s += rnd.choice(["T", " "]) + f"{rnd.choice([0, 9, 23, 24]):02d}:{rnd.choice([0, 30, 59, 60]):02d}"
            if rnd.random() < 0.7:
                s += f":{rnd.choice([0, 7, 59]):02d}"
                if rnd.random() < 0.5:
                    s += "." + "".join(rnd.choice("0123456789") for _ in range(rnd.choice([1, 3, 6])))
            if rnd.random() < 0.6:
                s += rnd.choice(["Z", "+02:00", "-05:30", "+00:00", "+0200", "-05"])
        kind = rnd.randrange(6)
        if kind == 0:
            s = s[:10].replace("-", "") + s[10:]            # basic date
        elif kind == 1:
            s = s[:10] + s[10:].replace(":", "")            # basic time
        elif kind == 2:
            s = s.replace(".", ",")
        elif kind == 3 and len(s) > 10:
            s = s[:13] + rnd.choice(["", "Z", "+01:00"])    # hour only
        out.append(s)
    return out


def py_ttl(s):
    try:
        t = dt.datetime.fromisoformat(s.replace("Z", "+00:00"))
    except ValueError:
        return None
    if t.tzinfo is None:
        t = t.replace(tzinfo=dt.timezone.utc)
    return int((t + dt.timedelta(hours=24)).timestamp())


def test_event_time_agrees_with_stdlib(spark):
    cases = iso_cases(random.Random(11))
    df = spark.createDataFrame([(s,) for s in cases], "s string")
    got = df.select("s", X.ttl_epoch(X.parse_event_time(F.col("s"))).alias("ttl")).collect()
    for r in got:
        assert r.ttl == py_ttl(r.s), (r.s, r.ttl, py_ttl(r.s))


def json_cases(rnd):
    out = []
    for _ in range(400):
        obj = {f"k{i}": rnd.choice([1, -2.5, "x y", None, True, [1, 2], {"a": "b"}])
               for i in range(rnd.randrange(0, 5))}
        s = json.dumps(obj, separators=rnd.choice([(",", ":"), (", ", ": ")]))
        kind = rnd.randrange(10)
        if kind == 1 and len(s) > 1:
            s = s[:rnd.randrange(1, len(s))]                  # cut
        elif kind == 2:
            s = s + rnd.choice([" x", "}", ",", "{}", " 1", "\n", " ", "\t"])   # after the value
        elif kind == 3:
            s = rnd.choice([" ", "\n", "\t"]) + s               # before the value
        elif kind == 4:
            s = s.replace('"', "'", 2)                           # single quotes
        elif kind == 5 and '"x y"' in s:
            s = s.replace('"x y"', '"x\ty"')                     # raw control character
        elif kind == 6 and ":1" in s.replace(" ", ""):
            s = s.replace("1", "01", 1)                          # leading zero
        elif kind == 7:
            s = s.replace("}", ",}", 1) if len(obj) else s       # trailing comma
        elif kind == 8:
            s = "/*c*/" + s                                      # comment
        out.append(s)
    return out


def py_is_object(s):
    try:
        return isinstance(json.loads(s), dict)
    except ValueError:
        return False


def test_strict_json_agrees_with_stdlib(spark):
    cases = json_cases(random.Random(5))
    df = spark.createDataFrame([(s,) for s in cases], "s string")
    got = df.select("s", X.is_object(X.parse_json_strict(F.col("s"))).alias("ok")).collect()
    for r in got:
        assert r.ok == py_is_object(r.s), (r.s, r.ok)
