"""Language identification by interpolated Kneser-Ney character models, one per language.

Texts are lower-cased; every run of non-letters is one space. A model holds, per order, the
sorted 64-bit hashes of its n-grams with their log probabilities, and those of its contexts
with their back-off weights. Languages are joined in blocks: one sorted hash array per order
for the block, with a row of log probabilities by language, so that a position is looked up
once for all of them. The language of lowest cross-entropy per character wins.

Fitting is classifier training on a bounded sample: of each language's different eligible texts
the ``TRAIN_DOCS`` + ``CALIBRATE_DOCS`` of smallest hash (of the text, so ids, shared or missing ones
too, and copies have no say), ``SAMPLE_BYTES`` at most, texts over ``LONG_BYTES`` only after all
others. Every third of them calibrates, the rest counts; a language with any eligible row has a text
to count. Calibration gives the temperature of the score (a softmax over languages) and
the cross-entropy beyond which a text is rejected.

Null text, or one without a letter: language ``und``, score 0, rejected. Null languages teach
nothing. With no eligible row at all every language is ``und``. Repeated rows get equal
results; extra columns pass through ``identified``, whose own names avoid theirs.
"""

from __future__ import annotations

import math
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from .common import free_name, map_arrow, small_batches, written

ORDER = 5
TRAIN_DOCS, CALIBRATE_DOCS = 500, 250
SAMPLE_BYTES, LONG_BYTES = 32 << 20, 4 << 20
#: Characters a model may give a probability to that it has never seen.
ALPHABET = 4096
#: A text is rejected if its best model takes it for foreign: beyond this share of the way from
#: the entropy of own texts to that of the nearest other language's (``FAR`` times that of own
#: texts at most), but not below this quantile of own texts, and these deviations more.
FOREIGN, FAR, OWN, DEVIATIONS = 0.5, 2.0, 0.995, 3.0
#: Languages in a block (a row of that many probabilities per n-gram).
BLOCK = 8
_CHUNK = 1 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)
UND = "und"

_letter: np.ndarray | None = None


def _letters() -> np.ndarray:
    """By code point: is it a letter (or a mark inside a word)?"""
    global _letter
    if _letter is None:
        _letter = np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)])
    return _letter


def normal(text: str) -> np.ndarray:
    """Code points: lower case, each run of other than letters one space, one before and behind."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _letters()[cp]
    if not is_letter.any():
        return np.zeros(0, np.uint32)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    out = np.where(is_letter, cp, np.uint32(32))[keep]
    return np.concatenate(([32], out, [32] if out[-1] != 32 else [])).astype(np.uint32)


def hashes(cp: np.ndarray, order: int = ORDER) -> list[np.ndarray]:
    """For n = 1 .. order the hash of the n characters that end at each position (0 where the
    text has not so many yet)."""
    c = (cp.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    c ^= c >> np.uint64(32)
    out = [c]
    for n in range(1, order):
        h = np.zeros(len(c), np.uint64)
        h[n:] = (out[-1][n - 1:-1] * _MUL) ^ c[n:]
        h[n:] ^= h[n:] >> np.uint64(29)
        out.append(h)
    return out


def train(texts, order: int = ORDER) -> list[dict]:
    """Interpolated Kneser-Ney model: by n the arrays gram, ctx, suf (hashes of an n-gram, of its
    first and its last n - 1 characters), logp, and context, backoff. Each is sorted by its hash."""
    counted: list[np.ndarray] = []          # rows of hashes n = 1 .. order + context, at the last character
    weight: list[np.ndarray] = []
    for t in texts:                         # unique n-grams with counts, text by text
        cp = normal(t)
        if len(cp) < 2:
            continue
        h = hashes(np.concatenate((np.full(order - 1, 32, np.uint32), cp)), order)
        rows = np.stack([x[order:] for x in h] + [x[order - 1:-1] for x in h[:-1]], axis=1)
        _, at, n = np.unique(h[-1][order:], return_index=True, return_counts=True)
        counted.append(rows[at])
        weight.append(n)
    if not counted:
        return []
    rows, n = np.concatenate(counted), np.concatenate(weight)
    top, at, inverse = np.unique(rows[:, order - 1], return_index=True, return_inverse=True)
    rows, count = rows[at], np.bincount(inverse, n).astype(np.float64)
    model: list[dict] = []
    for size in range(order, 0, -1):        # counts: raw for the longest, then of different predecessors
        gram = rows[:, size - 1]
        ctx = rows[:, order + size - 2] if size > 1 else np.zeros(len(rows), np.uint64)
        suf = rows[:, size - 2] if size > 1 else np.zeros(len(rows), np.uint64)
        n1, n2 = (count == 1).sum(), (count == 2).sum()
        discount = min(max(n1 / max(n1 + 2 * n2, 1), 0.1), 0.9)
        context, where = np.unique(ctx, return_inverse=True)
        total = np.bincount(where, count)
        backoff = discount * np.bincount(where) / total
        model.append({"gram": gram, "ctx": ctx, "suf": suf, "p": (count - discount) / total[where],
                      "context": context, "backoff": backoff, "where": where})
        if size > 1:
            _, at, inverse = np.unique(suf, return_index=True, return_inverse=True)
            rows, count = rows[at], np.bincount(inverse).astype(np.float64)
    model.reverse()
    lower = np.full(1, 1 / ALPHABET)
    for size, m in enumerate(model):
        below = lower[np.searchsorted(model[size - 1]["gram"], m["suf"])] if size else lower
        m["p"] = m["p"] + m["backoff"][m.pop("where")] * below
        lower = m["p"]
        m["logp"], m["backoff"] = np.log(m.pop("p")).astype(np.float32), np.log(m["backoff"]).astype(np.float32)
    return model


class Models:
    """The models of all languages, joined in blocks, with their calibration."""

    def __init__(self, models: dict[str, list[dict]]) -> None:
        self.langs = sorted(models)
        self.temperature, self.limits = 1.0, {}
        self.blocks = [self._joined([models[x] for x in self.langs[i:i + BLOCK]])
                       for i in range(0, len(self.langs), BLOCK)]

    @classmethod
    def of(cls, state: dict) -> Models:
        """From ``vars()`` of another: what is broadcast is plain data."""
        own = cls.__new__(cls)
        vars(own).update(state)
        return own

    @staticmethod
    def _joined(models: list[list[dict]]) -> list[tuple]:
        out: list[tuple] = []
        for n in range(len(models[0])):
            grams, at = np.unique(np.concatenate([m[n]["gram"] for m in models]), return_index=True)
            ctx = np.concatenate([m[n]["ctx"] for m in models])[at]
            suf = np.concatenate([m[n]["suf"] for m in models])[at]
            contexts = np.unique(np.concatenate([m[n]["context"] for m in models]))
            logp = np.zeros((len(grams), len(models)), np.float32)
            back = np.zeros((len(contexts), len(models)), np.float32)
            for k, m in enumerate(models):
                back[np.searchsorted(contexts, m[n]["context"]), k] = m[n]["backoff"]
            below = (out[-1][1][np.searchsorted(out[-1][0], suf)] if n
                     else np.full((1, len(models)), -math.log(ALPHABET), np.float32))
            logp[:] = back[np.searchsorted(contexts, ctx)] + below
            for k, m in enumerate(models):
                logp[np.searchsorted(grams, m[n]["gram"]), k] = m[n]["logp"]
            out.append((grams, logp, contexts, back))
        return out

    def _logp(self, block: list[tuple], h: list[np.ndarray], n: int, where: np.ndarray) -> np.ndarray:
        """Log probabilities by language of the n-grams at positions ``where``; those that no
        language has back off to n - 1."""
        grams, logp, contexts, back = block[n - 1]
        order = np.argsort(h[n - 1][where])                  # sorted searches stay in the cache
        where_sorted = where[order]
        asked = h[n - 1][where_sorted]
        spot = np.minimum(np.searchsorted(grams, asked), len(grams) - 1)
        out = logp[spot]
        miss = np.flatnonzero(grams[spot] != asked)
        if len(miss):
            at = where_sorted[miss]
            if n == 1:
                out[miss] = back[0] - math.log(ALPHABET)
            else:
                low = self._logp(block, h, n - 1, at)
                ctx = h[n - 2][at - 1]
                c = np.minimum(np.searchsorted(contexts, ctx), len(contexts) - 1)
                out[miss] = low + np.where((contexts[c] == ctx)[:, None], back[c], 0)
        result = np.empty_like(out)
        result[order] = out
        return result

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language the cross-entropy (nats per character); characters per text."""
        total, chars = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        pad = np.full(ORDER - 1, 32, np.uint32)

        def score(parts: list[tuple[int, np.ndarray]]) -> None:
            cp = np.concatenate([p for _, p in parts])
            h = hashes(cp)
            begins = np.cumsum([0] + [len(p) for _, p in parts[:-1]])
            where = np.concatenate([np.arange(b + ORDER, b + len(p)) for b, (_, p) in
                                    zip(begins.tolist(), parts, strict=True)])
            cuts = np.cumsum([0] + [len(p) - ORDER for _, p in parts[:-1]])
            rows = [i for i, _ in parts]
            for k, block in enumerate(self.blocks):
                logp = self._logp(block, h, ORDER, where)
                np.add.at(total, (rows, slice(k * BLOCK, k * BLOCK + logp.shape[1])),
                          np.add.reduceat(logp, cuts, axis=0, dtype=np.float64))

        held, size = [], 0
        for i, t in enumerate(texts):
            cp = normal(t) if t else ()
            if len(cp) < 2 or not self.langs:
                continue
            cp = np.concatenate((pad, cp))
            chars[i] = len(cp) - ORDER
            for s in range(0, len(cp) - ORDER, _CHUNK):      # a long text goes piece by piece, none of it skipped
                held.append((i, cp[s:s + _CHUNK + ORDER]))
                size += len(held[-1][1])
                if size >= _CHUNK:
                    score(held)
                    held, size = [], 0
        if held:
            score(held)
        return -total / np.maximum(chars, 1)[:, None], chars

    def calibrate(self, rows: list[tuple[str, int, list[float]]]) -> None:
        """From (language, characters, entropies) of texts that the models have not seen: the
        temperature that makes the softmax most likely, and per language the largest entropy that
        is not rejected (more for short texts, whose entropy scatters)."""
        rows = [r for r in rows if r[1] > 0 and r[0] in self.langs]
        if not rows:
            return
        own = np.array([self.langs.index(r[0]) for r in rows])
        ce, n = np.array([r[2] for r in rows]), np.array([r[1] for r in rows])

        def loss(t: float) -> float:
            z = -t * (ce - ce.min(axis=1, keepdims=True))
            return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), own]))
        self.temperature = min((2.0 ** (k / 2) for k in range(-4, 15)), key=loss)
        for k, lang in enumerate(self.langs):
            x, m, other = ce[own == k, k], n[own == k], own != k
            if len(x):
                mean = float(np.average(x, weights=m))
                # one that is not learned may be nearer than all that are
                foreign = min([FAR * mean, *(float(np.median(ce[own == j, k])) for j in np.unique(own[other]))])
                most = float(np.quantile(x, OWN))
                self.limits[lang] = (max(mean + FOREIGN * (foreign - mean), most),
                                     DEVIATIONS * 1.4826 * float(np.median(np.abs(x - mean) * np.sqrt(np.minimum(m, 200)))))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool], list[float]]:
        """Language, score, rejected and cross-entropy of each text."""
        ce, chars = self.entropies(texts)
        langs, scores, out, entropy = [], [], [], []
        for row, n in zip(ce, chars.tolist(), strict=True):
            if not n:
                langs.append(UND), scores.append(0.0), out.append(True), entropy.append(None)
                continue
            k = int(row.argmin())
            lang, z = self.langs[k], np.exp(-self.temperature * (row - row[k]))
            most, spread = self.limits.get(lang, (math.inf, 0.0))
            langs.append(lang), scores.append(float(1 / z.sum())), entropy.append(float(row[k]))
            out.append(bool(row[k] > most + spread / math.sqrt(n)))
        return langs, scores, out, entropy


def fold(key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo 4; 2 is held out of all fitting."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4


def drawn(able: DataFrame, train_docs: int, calibrate_docs: int) -> DataFrame:
    """(lang, text, fit): the sample of each language's texts. Copies meet in an aggregate that combines
    map side; about one and a half times the sample remains by its hash, and only this is ranked."""
    size = train_docs + calibrate_docs
    hashed = able.select("lang", "text", F.xxhash64("text").alias("h"))
    share = (F.col("h").bitwiseAND((1 << 53) - 1) / float(1 << 53)).alias("draw")
    hashed = hashed.select("*", share, (F.octet_length("text") > LONG_BYTES).alias("long"))
    sizes = hashed.groupBy("lang").agg(F.approx_count_distinct(F.when(~F.col("long"), F.col("h"))).alias("n"),
                                       F.approx_count_distinct("h").alias("all"))
    cut = F.when(F.col("long"), F.when(F.col("n") < 2 * size, 1.5 * size / F.greatest("all", F.lit(1))).otherwise(0.0)).otherwise(
        1.5 * size / F.greatest("n", F.lit(1)))
    near = (hashed.join(F.broadcast(sizes), "lang").where(F.col("draw") < cut)
            .groupBy("lang", "long", "h", "draw").agg(F.first("text").alias("text")))
    order = Window.partitionBy("lang").orderBy("long", "draw", "h")          # of a bounded number of texts
    ranked = near.select("lang", "text", (F.row_number().over(order) - 1).alias("rank"),
                         F.sum(F.octet_length("text").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("bytes"))
    chosen = ranked.where((F.col("rank") < size) & ((F.col("bytes") <= SAMPLE_BYTES) | (F.col("rank") == 0)))
    third = max(round(size / max(calibrate_docs, 1)), 2)
    return chosen.select("lang", "text", (F.col("rank") % third != third - 1).alias("fit"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        train_docs: int = TRAIN_DOCS, calibrate_docs: int = CALIBRATE_DOCS) -> Models:
    """Models from the rows of ``docs`` outside the held-out fold that have a text and a language."""
    spark = docs.sparkSession
    small_batches(spark)
    able = docs.where((F.coalesce(fold(key), F.lit(0)) != 2) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    sample = written(drawn(able.select(F.col(lang).alias("lang"), F.col(text).alias("text")), train_docs, calibrate_docs),
                     "langid_sample")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        model = train(pdf["text"])
        names = ("gram", "ctx", "suf", "logp", "context", "backoff")
        return pd.DataFrame([{"lang": pdf["lang"].iloc[0], "n": n, **{k: m[k].tobytes() for k in names}}
                             for n, m in enumerate(model)], columns=["lang", "n", *names])

    schema = "lang string, n int, gram binary, ctx binary, suf binary, logp binary, context binary, backoff binary"
    kinds = {"logp": np.float32, "backoff": np.float32}
    found: dict[str, list[dict]] = {}
    # bounded by the sample: one model per language
    for r in sample.where("fit").groupBy("lang").applyInPandas(one, schema).orderBy("lang", "n").toLocalIterator():
        found.setdefault(r["lang"], []).append(
            {k: np.frombuffer(r[k], kinds.get(k, np.uint64)) for k in ("gram", "ctx", "suf", "logp", "context", "backoff")})
    models = Models(found)
    held = spark.sparkContext.broadcast(vars(models))

    def make():
        own = Models.of(held.value)

        def f(texts):
            ce, chars = own.entropies(texts.to_pylist())
            return chars.tolist(), ce.tolist()
        return f
    fields = [T.StructField("chars", T.LongType()), T.StructField("ce", T.ArrayType(T.DoubleType()))]
    rows = map_arrow(sample.where("not fit"), ["text"], fields, make, keep=["lang"]).collect()
    models.calibrate(sorted((r["lang"], r["chars"], r["ce"]) for r in rows))
    return models


def identified(docs: DataFrame, models: Models, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with language, score, rejected and entropy, and the names these columns got."""
    held = docs.sparkSession.sparkContext.broadcast(vars(models))
    names = {n: free_name(docs, f"_{n}") for n in ("lang_pred", "score", "rejected", "entropy")}
    types = (T.StringType(), T.DoubleType(), T.BooleanType(), T.DoubleType())

    def make():
        own = Models.of(held.value)
        return lambda texts: own.predict(texts.to_pylist())
    fields = [T.StructField(n, t) for n, t in zip(names.values(), types, strict=True)]
    return map_arrow(docs, [text], fields, make), names


def predictions(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """Per row: key, held_out, lang_pred, score, rejected, entropy."""
    found, n = identified(docs.select(key, text), fit(docs, text, lang, key), text)
    return found.select(key, F.coalesce(fold(key) == 2, F.lit(False)).alias("held_out"),
                        *(F.col(v).alias(k) for k, v in n.items()))


def accepted(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """``docs`` without the rejected ones."""
    found, n = identified(docs, fit(docs, text, lang, key), text)
    return found.where(~F.col(n["rejected"])).select(*docs.columns)
