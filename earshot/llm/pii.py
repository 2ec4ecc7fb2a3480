"""Personal data by candidate spans and gradient-boosted trees, in column expressions.

Base spans follow the contract's rules and always stay. High-recall generators propose further,
overlapping spans (numbers in the shapes of phones, cards, addresses and identifiers, disguised
mail addresses). Boosted trees score each candidate by its format and its context. The documents
carry no labels of personal data, so the trees are fitted on example texts whose truth is known as
they are made: genuine data and look-alikes (failed checksums, valid ones in orders, versions and
part numbers), with and without words that announce them. So a label is no function of the
features, and the sample's size is fixed. One half of the examples fits, the other calibrates:
each kind's threshold is the least score from which on the precision there is at least
``PRECISION``. A candidate over its threshold that no base span and no earlier selected one overlaps
becomes a span. Fitted trees are written out as one column expression over the candidates of a
row, so scoring needs no shuffle and a single pass.

Arrays are never grown element by element: running positions are made in blocks of the root of
their number, and overlaps are counted by sorted ranks, so a text full of numbers takes a time
nearly in proportion to its length.

Null and empty texts have no spans; equal rows have equal spans; extra columns are ignored. An
empty table gives no rows, one without candidates only base spans. Positions are code points.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Base rules of the contract. A match begins where its first run of characters begins (or where
#: the last match ended), and runs are taken whole, which the rules' leftmost longest matches do too.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: kind, rule of a generator.
GENERATORS = [
    ("phone", r"(?<![0-9])\+?(?:[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"),
    ("card", r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])"),
    ("ip", r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])"),
    ("email", r"[A-Za-z0-9._%+-]{1,64} ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,64}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,64})++"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])"),
    ("number", r"(?<![0-9])[0-9]{5,12}(?![0-9])"),
]
#: Texts without a sign of mail have no mail candidate, those without digits no other.
SIGNS = r"@|[(\[]at[)\]]"
DIGITS = r"[0-9][0-9 ().+-]*[0-9]"
KINDS = ["email", "ip", "card", "phone", "ssn", "iban", "number"]
CUES = {"phone": "tel|phone|call|fax|mobil", "mail": "mail|contact|write", "card": "card|visa|credit|pay|konto|account|iban",
        "net": "ip|host|server|addr", "person": "ssn|social|security|passport|name|born",
        "thing": "order|part|item|sku|version|release|build|serial|invoice|ref|lot|page"}
CONTEXT = 24
EXAMPLES = 120          # example texts of each kind, look-alike and context
PRECISION, LEAST = 0.95, 0.5
TREES, DEPTH = 16, 5


def spans(df: DataFrame, text: str, rules: list[tuple[str, str]], name: str) -> DataFrame:
    """``df`` with an array ``name`` of (kind, start, end, hit, before, after) for all matches of all
    rules, rule by rule. A rule's matches and the gaps between them are found by the same search,
    so their lengths add up to positions."""
    keep, parts = df.columns, []
    # each test is a column of its own, evaluated once; most texts fail the first two
    df = df.withColumns({"_sign": F.col(text).rlike(SIGNS), "_number": F.col(text).rlike(DIGITS)})
    df = df.withColumns({f"_some{i}": F.when(F.col("_sign" if "@" in rule else "_number"), F.col(text).rlike(rule))
                         for i, (_, rule) in enumerate(rules)})
    df = df.withColumns({f"_{name}{i}": F.when(F.col(f"_some{i}"), found) for i, (_, rule) in enumerate(rules) for name, found in (
        ("hit", F.regexp_extract_all(text, F.lit(rule), F.lit(0))), ("gap", F.split(text, rule, -1)))})
    for i, (kind, _) in enumerate(rules):
        hit, gap = f"_hit{i}", f"_gap{i}"
        parts.append(F.coalesce(_positions(kind, hit, gap), F.array().cast(_SPANS)))
    return df.select(*keep, F.concat(*parts).alias(name))


_SPANS = "array<struct<kind:string,start:int,end:int,hit:string,before:string,after:string>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, also where ``use`` reads it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(items: Column, zero: Column, step: Callable, kind: str) -> Column:
    """For each item, ``out`` of ``step(state, item) -> (state, out)``. The items are taken in blocks of
    the root of their number, so that no array is copied once for each item."""
    def blocks(x):
        size = F.ceil(F.sqrt(F.size(x))).cast("int")
        return F.transform(F.sequence(F.lit(0), F.ceil(F.size(x) / size).cast("int") - 1), lambda b: F.slice(x, b * size + 1, size))

    def one(done, x):
        state, out = step(done["at"], x)
        return F.struct(state.alias("at"), F.concat(done["out"], F.array(out)).alias("out"))

    def block(done, x):
        inner = F.aggregate(x, F.struct(done["at"].alias("at"), F.array().cast(f"array<{kind}>").alias("out")), one)
        return _let(inner, lambda v: F.struct(v["at"].alias("at"), F.concat(done["out"], F.array(v["out"])).alias("out")))
    start = F.struct(zero.alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    return _let(items, lambda x: F.when(F.size(x) == 0, F.array().cast(f"array<{kind}>")).otherwise(
        F.aggregate(blocks(x), start, block, lambda done: F.flatten(done["out"]))))


def _positions(kind: str, hit: str, gap: str) -> Column:
    def build(both):
        hits, gaps = both["hit"], both["gap"]
        lengths = F.transform(hits, lambda h, i: F.length(F.get(gaps, i)) + F.length(h))
        ends = _running(lengths, F.lit(0), lambda at, n: (at + n, at + n), "int")
        return _let(ends, lambda end: F.transform(hits, lambda h, i: F.struct(
            F.lit(kind).alias("kind"), (F.get(end, i) - F.length(h)).alias("start"), F.get(end, i).alias("end"), h.alias("hit"),
            F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("after"))))
    return F.when(F.col(hit).isNotNull(), _let(F.struct(F.col(hit).alias("hit"), F.col(gap).alias("gap")), build))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_QUAD = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"


def valid(s: Column) -> Column:
    """Does a match of a base rule pass its check?"""
    n = F.length(_digits(s["hit"]))
    return (F.when(s["kind"] == "email", True)
            .when(s["kind"] == "ip", s["hit"].rlike(_QUAD))
            .when(s["kind"] == "card", n.between(14, 19) & F.call_function("luhn_check", _digits(s["hit"])))
            .otherwise(n.between(10, 15)))


#: Words that announce a number of a person or an account, right before it.
_ANNOUNCED = (r"(?:passport|social security|ssn|tax id|national id|account|konto)(?:[ -]?(?:no|nr|number|id))?"
              r"[^a-z0-9]{0,4}$")
_CALLED = rf"(?:{CUES['phone']})[a-z]*[^0-9]{{0,12}}$"
#: Digits by issuer and length; North American numbers: area and exchange begin with 2 to 9.
_ISSUED = (r"^(?:4[0-9]{12}(?:[0-9]{3}){0,2}|5[1-5][0-9]{14}|2[2-7][0-9]{14}|3[47][0-9]{13}|3[0689][0-9]{12}"
           r"|35[0-9]{14}|6(?:011|4[4-9][0-9]|5[0-9]{2})[0-9]{12,15})$")
_PLAN = r"^1?[2-9][0-8][0-9][2-9][0-9]{6}$"
_SSN = r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"
_MAIL = r"(?:\.|\(dot\)|\[dot\]) ?[A-Za-z]{2,24}$"


def _glued(s: Column) -> Column:
    """Does the candidate go on in letters or digits?"""
    return s["before"].rlike("[A-Za-z0-9]$") | s["after"].rlike("^[A-Za-z0-9]")


def _mod97(hit: Column) -> Column:
    """Is it 1, as IBANs have it (country and check digits last, letters as 10 to 35)?"""
    flat = F.regexp_replace(hit, " ", "")
    signs = F.split(F.concat(F.substring(flat, 5, 64), F.substring(flat, 1, 4)), "")

    def step(rest, c):
        v = F.coalesce(F.conv(c, 36, 10).cast("int"), F.lit(0))
        return (rest * F.when(v > 9, 100).otherwise(10) + v) % 97
    return F.length(flat).between(15, 34) & (F.aggregate(signs, F.lit(0), step) == 1)


def check(s: Column) -> Column:
    """Does the candidate keep the rules of its kind (checksum, plan, range)?"""
    digits = _digits(s["hit"])
    return F.coalesce(
        F.when(s["kind"] == "email", s["hit"].rlike(_MAIL))
        .when(s["kind"] == "ip", s["hit"].rlike(_QUAD))
        .when(s["kind"] == "card", digits.rlike(_ISSUED) & F.call_function("luhn_check", digits))
        .when(s["kind"] == "phone", digits.rlike(_PLAN) | (s["hit"].startswith("+") & F.length(digits).between(10, 15)))
        .when(s["kind"] == "ssn", s["hit"].rlike(_SSN))
        .when(s["kind"] == "iban", _mod97(s["hit"])), F.lit(False))


def rule(s: Column) -> Column:
    """What rules alone would select: checked candidates that don't go on in letters or digits, bare
    digits where the words before them say what they are. The trees are held against it."""
    near, bare = F.lower(s["before"]), s["hit"].rlike("^[0-9]+$")
    return ~_glued(s) & (F.when(s["kind"] == "number", near.rlike(_ANNOUNCED))
                         .when(s["kind"] == "phone", (check(s) & ~bare) | near.rlike(_CALLED))
                         .otherwise(check(s)))


def examples(seed: int = 42, size: int = EXAMPLES) -> list[tuple[str, str | None, int]]:
    """(text, kind, start): invented texts with genuine data of a kind at start, or with none."""
    rng = random.Random(seed)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("aeilnorstu") for _ in range(rng.randint(2, 8)))

    def card(good: bool) -> str:
        body = "4" + digits(14)
        total = sum(sum(divmod(int(c) * (2 - i % 2), 10)) for i, c in enumerate(body))
        whole = body + str((-total + (0 if good else rng.randint(1, 9))) % 10)
        return rng.choice([whole, " ".join(whole[i:i + 4] for i in range(0, 16, 4))])

    def iban(good: bool) -> str:
        land, size = rng.choice([("DE", 18), ("GB", 18), ("FR", 23), ("ES", 20), ("NL", 14), ("AT", 16), ("IT", 23)])
        body = {"GB": "WEST", "NL": "ABNA", "IT": "X"}.get(land, "")
        body += digits(size - len(body))
        proof = 98 - int("".join(str(int(c, 36)) for c in body + land + "00")) % 97
        whole = f"{land}{proof if good else (proof + rng.randint(1, 90)) % 97:02d}{body}"
        return rng.choice([whole, " ".join(whole[i:i + 4] for i in range(0, len(whole), 4))])

    def phone(good: bool) -> str:
        area, rest = rng.choice("23456789" if good else "01") + rng.choice("012345678") + digits(1), digits(4)
        mid = rng.choice("23456789" if good else "01") + digits(2)
        return rng.choice([f"({area}) {mid}-{rest}", f"{area}-{mid}-{rest}", f"{area}.{mid}.{rest}", f"{area} {mid} {rest}",
                           f"1-{area}-{mid}-{rest}", f"+1 ({area}) {mid}-{rest}", f"+1 {area} {mid} {rest}"])

    def ssn(good: bool) -> str:
        area = f"{rng.randint(1, 665) if good else rng.choice([0, 666, rng.randint(900, 999)]):03d}"
        return f"{area}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}"

    def mail(good: bool) -> str:
        at, dot = rng.choice([(" (at) ", " (dot) "), ("[at]", "[dot]"), (" @ ", "."), ("@", ".")])
        return f"{word()}{at}{word()}{dot}" + (rng.choice(["com", "org", "de", "net", "example"]) if good else digits(3))

    def net(good: bool) -> str:
        return ".".join(str(rng.randint(0, 255) if good else rng.randint(256, 999)) for _ in range(4))

    made = {"card": card, "iban": iban, "phone": phone, "ssn": ssn, "email": mail, "ip": net}
    cue = {"card": ["card", "visa", "credit", "pay"], "iban": ["iban", "account", "konto"], "phone": ["call", "tel", "fax", "phone"],
           "ssn": ["ssn", "social security", "born"], "email": ["mail", "write to", "contact"], "ip": ["host", "server", "ip address"]}
    things = ["order", "part no", "item", "sku", "version", "release", "build", "serial", "invoice", "ref", "lot"]
    link = lambda: rng.choice([" ", ": ", " no. ", " = ", f" {word()} "])
    out: list[tuple[str, str | None, int]] = []

    def add(kind: str | None, before: str, hit: str, after: str = "") -> None:
        head = f"{word()} {word()} {before}"
        out.append((f"{head}{hit}{after or rng.choice(['', '.', ', ', ' '])}{'' if after else f' {word()}'}", kind, len(head)))
    for kind, make in made.items():
        for _ in range(size):
            add(kind, "", make(True))                                   # nothing announces it
            add(kind, rng.choice(cue[kind]) + link(), make(True))
            add(None, "", make(False))                                  # its check fails
            add(None, rng.choice(cue[kind]) + link(), make(False))
            add(None, rng.choice(things) + link(), make(True))          # by chance its check holds
            add(None, rng.choice(things) + link(), make(False))
            if kind != "email":
                add(None, rng.choice("abcxyz"), make(True), rng.choice("defghi"))    # part of something longer
    for _ in range(size):
        add("number", rng.choice(["account no. ", "passport ", "tax id: ", "passport number ", "konto "]), digits(rng.randint(5, 12)))
        add("phone", rng.choice(cue["phone"]) + rng.choice([" ", ": "]), digits(10))
        for n in (rng.randint(5, 12), 10, 14, 16):
            add(None, "", digits(n))
            add(None, rng.choice(things) + link(), digits(n))
        add(None, "a", digits(rng.randint(7, 16)), "f ")
        add(None, "", " ".join(digits(rng.randint(1, 4)) for _ in range(6)))
    return out


def features(s: Column) -> list[Column]:
    """Numbers for the trees: format of the span, and what stands around it."""
    hit, digits, near = s["hit"], _digits(s["hit"]), F.lower(s["before"])
    flags = [
        digits.rlike("^[0-9]{13,19}$") & F.coalesce(F.call_function("luhn_check", digits), F.lit(False)), hit.rlike(_QUAD),
        hit.startswith("+"), hit.contains("("), hit.contains("@"), hit.contains("."), hit.contains("-"),
        s["before"].rlike("[A-Za-z0-9]$"), s["after"].rlike("^[A-Za-z0-9]"), s["before"].rlike("[=\"':#/]$"),
        check(s), _glued(s), hit.rlike("^[0-9]+$"), near.rlike(_ANNOUNCED), near.rlike(_CALLED),
        *(near.rlike(c) for c in CUES.values())]
    numbers = [F.length(digits), F.length(hit), F.length(F.regexp_replace(hit, "[^A-Za-z]", "")),
               *(F.when(s["kind"] == k, 1.0).otherwise(0.0) for k in KINDS)]
    return [*(x.cast("double") for x in numbers), *(F.coalesce(f, F.lit(False)).cast("int").cast("double") for f in flags)]


def _numbers(x: Column) -> list[Column]:
    """The features of an array ``x``, one by one."""
    empty = F.struct(*(F.lit("").alias(c) for c in ("kind", "hit", "before", "after")))
    return [F.get(x, F.lit(i)) for i in range(len(features(empty)))]


def _below(points: Column, marks: Column, equal: bool) -> Column:
    """For each of ``points``, how many of ``marks`` are less (or ``equal``), by one sort of both."""
    tagged = F.concat(F.transform(marks, lambda p: F.struct(p.alias("p"), F.lit(0 if equal else 1).alias("t"), F.lit(-1).alias("i"))),
                      F.transform(points, lambda p, i: F.struct(p.alias("p"), F.lit(1 if equal else 0).alias("t"), i.alias("i"))))
    placed = F.filter(F.transform(F.sort_array(tagged), lambda e, k: F.struct(e["i"].alias("i"), k.alias("k"))), lambda e: e["i"] >= 0)
    ranks = F.transform(placed, lambda e, j: F.struct(e["i"].alias("i"), (e["k"] - j).alias("rank")))
    return F.transform(F.sort_array(ranks), lambda e: e["rank"])


def _apart(found: Column, base: Column) -> Column:
    """The spans of ``found`` that overlap none of ``base``: as many base spans end at their start or
    before it as start before their end."""
    starts = _below(F.transform(found, lambda s: s["end"]), F.transform(base, lambda b: b["start"]), False)
    ends = _below(F.transform(found, lambda s: s["start"]), F.transform(base, lambda b: b["end"]), True)
    return _let(F.struct(starts.alias("a"), ends.alias("b")), lambda r: F.filter(
        found, lambda s, i: F.get(r["a"], i) == F.get(r["b"], i)))


def candidates(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(key, base, found): valid base spans and what the generators propose beyond them or on them, each
    with its features ``x``."""
    rows = docs.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = spans(rows, "_text", [*BASE.items()], "_matches")
    rows = rows.withColumn("base", F.filter("_matches", valid)).drop("_matches")
    rows = spans(rows, "_text", GENERATORS, "_found").drop("_text")
    return rows.withColumn("found", F.transform("_found", lambda s: s.withField("x", F.array(*features(s))))).drop("_found")


class Model:
    """Trees as nested (feature, threshold, left, right) or a leaf's number, their weights, thresholds by kind."""

    def __init__(self, trees: list, weights: list[float]) -> None:
        self.trees, self.weights, self.least = trees, weights, {}

    def score(self, x: list[Column]) -> Column:
        def walk(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            f, cut, left, right = node
            return F.when(x[f] <= cut, walk(left)).otherwise(walk(right))
        total = reduce(lambda a, b: a + b, (walk(t) * w for t, w in zip(self.trees, self.weights, strict=True)))
        return 1.0 / (1.0 + F.exp(-2.0 * total))

    def chosen(self, s: Column) -> Column:
        kinds = F.create_map(*(F.lit(v) for k in KINDS for v in (k, self.least.get(k, 2.0))))
        return self.score(_numbers(s["x"])) >= kinds[s["kind"]]


def _tree(node):
    if node.getClass().getSimpleName() == "LeafNode":
        return node.prediction()
    return node.split().featureIndex(), node.split().threshold(), _tree(node.leftChild()), _tree(node.rightChild())


def labelled(spark: SparkSession, texts: list[tuple[str, str | None, int]]) -> DataFrame:
    """(s, label, fit): the candidates of example texts; those of a text fit or calibrate together."""
    found, halves = [], random.Random(len(texts))
    for text, kind, start in texts:
        fits = halves.random() < 0.5
        for name, pattern in GENERATORS:
            found += [(name, m.start(), m.end(), m[0], text[:m.start()][-CONTEXT:], text[m.end():][:CONTEXT],
                       float(name == kind and m.start() == start), fits) for m in re.finditer(pattern, text)]
    rows = spark.createDataFrame(found, "kind string, start int, end int, hit string, before string, after string, label double, fit boolean")
    s = F.struct(*rows.columns[:6])
    return rows.select(s.withField("x", F.array(*features(s))).alias("s"), "label", "fit")


def fit(spark: SparkSession) -> Model:
    """Trees and thresholds from the example texts; the sample is the same whatever the documents are."""
    rows = labelled(spark, examples())
    sample = rows.where("fit").select("label", array_to_vector("s.x").alias("features"))
    fitted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=42, maxBins=32).fit(sample)
    model = Model([_tree(t.rootNode()) for t in fitted._java_obj.trees()], list(fitted.treeWeights))
    bins = (rows.where(~F.col("fit")).select(F.col("s.kind").alias("kind"), "label",
                                             F.floor(model.score(_numbers(F.col("s.x"))) * 100).cast("int").alias("bin"))
            .groupBy("kind", "label", "bin").agg(F.count(F.lit(1)).alias("n")).collect())  # <= kinds * 2 * 101 rows
    for kind in KINDS:
        good = bad = 0
        for b in range(100, -1, -1):
            for r in bins:
                if r["kind"] == kind and r["bin"] == b:
                    good, bad = (good + r["n"], bad) if r["label"] else (good, bad + r["n"])
            if good + bad and good / (good + bad) >= PRECISION:
                model.least[kind] = max(b / 100, LEAST)
    return model


def _selected(model: Model) -> Column:
    """Candidates over their thresholds, by start (longer first), without overlaps among themselves or with base."""
    order = F.create_map(*(F.lit(v) for i, (k, _) in enumerate(GENERATORS) for v in (k, i)))

    def chosen(over):
        by_start = F.sort_array(F.transform(over, lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("size"), order[s["kind"]].alias("rule"), s.dropFields("x").alias("s"))))
        takes = lambda at, s: (F.when(s["start"] >= at, -s["size"]).otherwise(at), s["start"] >= at)
        return _let(by_start, lambda x: _let(_running(x, F.lit(0), takes, "boolean"), lambda taken: F.transform(
            F.filter(x, lambda _, i: F.get(taken, i)), lambda s: s["s"])))
    over = F.filter("found", model.chosen)
    return F.when(F.size("found") == 0, F.array().cast(_SPANS)).otherwise(_let(over, lambda x: F.when(
        F.size(x) == 0, F.array().cast(_SPANS)).otherwise(chosen(_apart(x, F.col("base"))))))


def _joined(name: str) -> Column:
    """kind:start:end by start, then kind as listed."""
    place = F.create_map(*(F.lit(v) for i, k in enumerate(KINDS) for v in (k, i)))
    order = F.transform(name, lambda s: F.struct(s["start"].alias("start"), place[s["kind"]].alias("place"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(order), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, counts of base spans by kind, digest of base spans, all spans, number of added ones."""
    found = candidates(docs, text, key)
    rows = found.withColumn("added", _selected(fit(docs.sparkSession)))
    rows = rows.withColumn("spans", F.concat("base", "added"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return rows.select(key, *(count(k).alias(f"n_{k}") for k in BASE),
                       F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"),
                       F.size("added").cast("long").alias("n_added"))
