import random
import re

from earshot.llm import automaton, secret_scan


def brute(text):
    out = []
    for kind, rule, least in secret_scan.RULES:
        for m in re.finditer(rule, text):
            if (len(m[2]) if kind == "assign" else len(m[0])) >= least:
                end = m.end()
                runs = [r.end() for r in re.finditer("[A-Za-z0-9+/=]{16,}", m[0])]
                if kind == "private_key" and runs and not m[0].endswith("-----") and text[end:end + 1] not in ("", "\n", "\r", "\\", '"', "'"):
                    end = m.start() + runs[-1]          # what follows on the line is prose
                out.append((kind, m.start(), end))
    return sorted(out)


def test_spans_equal_the_regex_library():
    scanner = automaton.RuleScanner(automaton.RuleScanner.tables([r[:2] for r in secret_scan.RULES]))
    parts = ["token", "secret", "passwd", "password", "api_key", "APIKEY", " ", "=", ":", "'", '"', "a1", "é", "😂", "AKIA",
             "ABCD1234EFGH", "deadbeef0123", "ghp_", "xoxb-", "AIza", "sk_live_", "eyJhbGciOi", "-----BEGIN RSA PRIVATE KEY-----",
             "\n", "-", ".", "/"]
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert sorted(secret_scan.find_spans(scanner, text)) == brute(text), text


def test_automaton_is_minimal_and_agrees():
    tables = automaton.compiled(["(a|b)*abb"], anywhere=False)
    assert len(tables["next"]) == 5                       # four states and the dead one
    run = automaton.Automaton(tables)
    for text in ("abb", "aabb", "babb", "ab", "abba", ""):
        assert bool(run.accepts(text.encode())[-1:] == [len(text)]) == bool(re.fullmatch("(a|b)*abb", text))


def test_long_runs_stay_linear():
    scanner = automaton.RuleScanner(automaton.RuleScanner.tables([r[:2] for r in secret_scan.RULES]))
    assert secret_scan.find_spans(scanner, "a" * 300_000) == [("hex", 0, 300_000)]


def test_private_keys_are_found_whole(spark):
    rng = random.Random(4)
    line = lambda n=64: "".join(rng.choices("ABCDEFXYZabcdefxyz0123456789+/", k=n))
    body = [line(), line(), line(), line(17) + "=="]
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    heads = ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0123ABCD", ""]
    pgp = ["-----BEGIN PGP PRIVATE KEY BLOCK-----", "Version: GnuPG v2.0 (GNU/Linux)", "", *body, "=aB1c", "-----END PGP PRIVATE KEY BLOCK-----"]
    whole = ["\n".join([begin, *body, end]), "\r\n".join([begin, *body, end]), "\\n".join([begin, *body, end]), "\\r\\n".join([begin, *body, end]),
             "\n".join([begin, *heads, *body, end]), "\n    ".join([begin, *body, end]), " ".join([begin, *body, end]), "\n".join(pgp),
             '\\n" +\n  "'.join([begin, *body, end]), "\n".join([begin, *body]), "\\n".join([begin, *heads, *body[:3]]), "\n".join([begin, *body[:2]]), begin]
    scanner = automaton.RuleScanner(automaton.RuleScanner.tables([r[:2] for r in secret_scan.RULES]))
    texts = []
    for key in whole:
        for before, after in (("", ""), ("é key:\n", "\n\n- é, words after it"), ("x ", ". It ends")):
            text = before + key + after
            spans = [s for s in secret_scan.find_spans(scanner, text) if s[0] == "private_key"]
            assert spans == [("private_key", len(before), len(before) + len(key))], text
            assert spans == [s for s in brute(text) if s[0] == "private_key"]
            texts.append((text, before + "[SECRET]" + after))
    twice = whole[0] + "\nand\n" + whole[4]
    texts += [(twice, "[SECRET]\nand\n[SECRET]"), (begin + "\nis the first line of a key file", "[SECRET]\nis the first line of a key file")]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs).collect()}
    assert [found[i] for i in range(len(texts))] == [w for _, w in texts]


def test_prose_behind_an_unterminated_key_stays():
    rng = random.Random(6)
    line = lambda n=64: "".join(rng.choices("ABCDEFXYZabcdefxyz0123456789+/", k=n))
    scanner = automaton.RuleScanner(automaton.RuleScanner.tables([r[:2] for r in secret_scan.RULES]))
    begin = "-----BEGIN RSA PRIVATE KEY-----"
    for key, after in [("\n".join([begin, line(), line()]), "\nPlease rotate it."), ("\n".join([begin, line(), line(20)]), " Please rotate it."),
                       ("\n".join([begin, line(), line(9) + "="]), "\nPlease, do"), ("\n".join([begin, line(), line(9) + "="]), ""),
                       ("\n".join([begin, *heads_and(line)]), "\n\nPlease rotate"), (begin, " Please")]:
        text = "é " + key + after
        spans = [s for s in secret_scan.find_spans(scanner, text) if s[0] == "private_key"]
        assert spans == [("private_key", 2, 2 + len(key))], text


def heads_and(line):
    return ["Proc-Type: 4,ENCRYPTED", "", line(), line(30)]
