"""Secret scans by one combined deterministic automaton (see ``automaton``).

``scan`` finds spans, ``redact`` replaces them in the texts. Both work row by row, without a
shuffle, so a hot source or a group of copies costs no more than its rows.

Null and empty texts have no spans. Repeated rows give repeated results. Extra columns pass
through ``redact`` and are left out by ``scan``; names it needs for itself avoid theirs.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .automaton import RuleScanner
from .common import free_name, map_arrow, spans_text

_KEY = r"((RSA|DSA|EC|OPENSSH|PGP|ENCRYPTED) )?PRIVATE KEY( BLOCK)?-----"
#: Lines of a key before its body, and what stands between base64 lines: line ends (also written as
#: escapes), indents, quotes, comment signs.
_KEY_HEADS = (r"([\x20\t\r\n\\>#*]+(r\\)?[rn]?(Proc-Type|DEK-Info|Content-Domain|Version|Comment|MessageID|Hash|Charset):"
              r"[^\r\n\\-]*(-[^\r\n\\-]+)*)*")
_KEY_BODY = r'''[A-Za-z0-9+/=\x20\t\r\n\\"'>#*,;]*'''
_KEY_NEXT = r'''[\x20\t\r\n\\"'>#*,;]*([rn]\\[\x20\t\r\n\\"'>#*,;]*)*'''
#: A private key to its END line; without one, to its last base64 line (lines of 16 characters and
#: more, and a shorter one behind them).
PRIVATE_KEY = (rf"-----BEGIN {_KEY}{_KEY_HEADS}({_KEY_BODY}-----END {_KEY}"
               rf"|({_KEY_NEXT}[A-Za-z0-9+/=]{{16,}})+({_KEY_NEXT}[A-Za-z0-9+/=]+)?)?")
#: name, rule, least length of a match (of group 2 for ``assign``). The first three are fixed by
#: the contract; the others are published formats of common credentials. A match that is too
#: short is dropped after it has been taken, so no shorter one is tried inside it.
RULES = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    ("access", r"AKIA[A-Z0-9]+", 20),
    ("hex", r"[0-9a-f]{24,}", 24),
    ("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    ("google", r"AIza[0-9A-Za-z_-]+", 39),
    ("stripe", r"[rs]k_(live|test)_[0-9A-Za-z]+", 24),
    ("jwt", r"eyJhbGciOi[A-Za-z0-9_.-]+", 40),
    ("private_key", PRIVATE_KEY, 27),
]
BASE = ("assign", "access", "hex")
KINDS = [r[0] for r in RULES]


_LAST_LINE = re.compile(rb"(?s).*[A-Za-z0-9+/=]{16}")


def _key_end(data: bytes, start: int, end: int) -> int:
    """End of a private key's match: the shorter run behind its last base64 line counts only where it ends
    its line, otherwise it is the prose that goes on behind the key."""
    whole = data[end - 5:end] == b"-----" or data[end:end + 1] in (b"", b"\n", b"\r", b"\\", b'"', b"'")
    last = None if whole else _LAST_LINE.match(data, start, end)
    return end if last is None else last.end()


def find_spans(scanner: RuleScanner, text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points."""
    data = text.encode("utf-8", "surrogatepass")
    found = []
    for r, s, e in scanner.spans(data):
        name, rule, least = RULES[r]
        size = len(re.fullmatch(rule.encode(), data[s:e])[2]) if name == "assign" else e - s
        if size >= least:
            found.append((name, s, _key_end(data, s, e) if name == "private_key" else e))
    if found and len(data) != len(text):
        points = {0: 0}
        at = 0
        for b in sorted({x for _, s, e in found for x in (s, e)}):
            points[b] = points[at] + len(data[at:b].decode("utf-8", "surrogatepass"))
            at = b
        found = [(k, points[s], points[e]) for k, s, e in found]
    return found


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: ``key``, counts of the base kinds, digest of their spans, all spans, their number."""
    tables = RuleScanner.tables([r[:2] for r in RULES])

    def make():
        scanner = RuleScanner(tables)

        def f(texts):
            counts, digests, spans, total = [[], [], []], [], [], []
            for t in texts.to_pylist():
                found = find_spans(scanner, t) if t else []
                for c, k in zip(counts, BASE, strict=True):
                    c.append(sum(x[0] == k for x in found))
                base = spans_text([x for x in found if x[0] in BASE], KINDS)
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                spans.append(spans_text(found, KINDS))
                total.append(len(found))
            return *counts, digests, spans, total
        return f

    long, string = T.LongType(), T.StringType()
    return map_arrow(docs, [text], [T.StructField(n, t) for n, t in (
        ("n_assign", long), ("n_access", long), ("n_hex", long), ("base_sha256", string),
        ("spans", string), ("n_spans", long))], make, keep=[key])


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", length: str | None = None) -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mark``; the column
    ``length``, if given, holds the new length of a changed text. No row is dropped."""
    tables = RuleScanner.tables([r[:2] for r in RULES])
    clean = free_name(docs, "_clean")

    def make():
        scanner = RuleScanner(tables)

        def one(t):
            if not t:
                return None
            out, at, until = [], 0, 0
            for _, s, e in sorted(find_spans(scanner, t), key=lambda x: x[1]):
                if s >= until:
                    out += [t[at:s], mark]
                at = until = max(until, e)
            return "".join([*out, t[at:]]) if until else None
        return lambda texts: ([one(t) for t in texts.to_pylist()],)

    done = map_arrow(docs, [text], [T.StructField(clean, T.StringType())], make)
    new = {text: F.coalesce(F.col(clean), F.col(text))}
    if length:
        new[length] = F.when(F.col(clean).isNull(), F.col(length)).otherwise(
            F.length(clean).cast(docs.schema[length].dataType))
    return done.withColumns(new).select(*docs.columns)
