"""Conversation repair, periodic runs, secret scans."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from fitledger.llm import conversation_repair as repair
from fitledger.llm.conversation_repair import repair_conversations, turn_gaps
from fitledger.llm.periodic_runs import _numbered, find_runs, periodic_runs
from fitledger.llm.queries import QUERIES
from fitledger.llm.secret_scan import KINDS, Joined, base_spans, find_secrets, key_likeness, secret_spans

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, runs string, spans string, id string, collapsed string, n_words long"
CLASH = ("clash",) * 5 + (7,)


# ---- conversations

def _walk(codes, entry):
    """Least (cost, edits) to each last role, row by row, without heaps."""
    best = {entry: (0, "")}
    for code in codes:
        for _ in range(3):
            for s, (cost, edits) in list(best.items()):
                for letter in "ua":
                    to, found = repair.NEXT.get((s, letter)), (cost + 5, edits + "I")
                    if to is not None and found < best.get(to, (1 << 60, "")):
                        best[to] = found
        after = {}
        for s, (cost, edits) in best.items():
            steps = [("D", 2, s)]
            if code not in "bd":
                more = 5 if code.isupper() else 0
                if (s, code.lower()) in repair.NEXT:
                    steps.append(("K", more, repair.NEXT[s, code.lower()]))
                steps += [("R", 1 + more, repair.NEXT[s, x]) for x in "ua" if (s, x) in repair.NEXT]
            for edit, price, to in steps:
                after[to] = min(after.get(to, (1 << 60, "")), (cost + price, edits + edit))
        best = after
    return best


def test_lattice_search_against_dynamic_programming():
    rng = random.Random(11)
    for _ in range(1500):
        codes = "".join(rng.choices("suaouauaSUAObd", k=rng.randint(0, 12)))
        for entry in range(4):
            expected = _walk(codes, entry)
            assert all(repair.cheapest(codes, entry, end) == expected.get(end) for end in range(4))
        whole = min((c + repair.CLOSING[s][0], e + repair.CLOSING[s][1]) for s, (c, e) in _walk(codes, 0).items())
        for size in (1, 2, 5, 50):
            joined = repair.Joined()
            for k in range(0, len(codes), size):
                joined.add(codes[k:k + size], codes[k:k + size].lower(), repair.segment_paths(codes[k:k + size], k == 0))
            assert joined.best() == whole


TURNS = "conv_id long, turn long, role string, text string, audit string, position long, conv string"


def _verdicts(spark, rows):
    table = spark.createDataFrame([(*r, "clash", 3, "clash") for r in rows], TURNS)
    found = repair_conversations(table).collect()
    texts = {}
    for r in sorted((r for r in found if r.position is not None), key=lambda r: r.position):
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    closing = {r.conv_id: r for r in found if r.position is None}
    assert len(closing) + sum(map(len, texts.values())) == len(found)
    for key, r in closing.items():
        assert r.digest == hashlib.sha256("\n".join(texts.get(key, [])).encode()).hexdigest()
    return closing, texts


def test_repair_of_odd_rows(spark):
    closing, texts = _verdicts(spark, [
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes."),          # as it should be
        (2, None, None, "No role."), (2, 1, "assistant", None), (2, 5, "assistant", "Answer!\n"),
        (None, 3, "user", "x" * 200_000 + "."), (None, 4, "assistant", "ok?"),
        (3, 1, "user", ""), (3, 1, "user", " \t"), (4, 1, "system", "Only this."),
        (5, 1, "user", "Same."), (5, 1, "user", "Same."), (5, 2, "assistant", "cut"), (6, 1, "", "")])
    got = {k: (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for k, r in closing.items()}
    assert got == {1: (0, 0, 0, 0, 0, "KKK"), 2: (1, 0, 0, 2, 3, "RDK"), None: (0, 0, 0, 0, 0, "KK"),
                   3: (2, 0, 0, 1, 4, "DD"), 4: (0, 0, 0, 0, 2, "D"), 5: (0, 1, 1, 1, 6, "DDD"), 6: (1, 0, 0, 0, 2, "D")}
    assert texts[2] == ["user:No role.", "assistant:Answer!\n"] and 3 not in texts
    empty = spark.createDataFrame([], TURNS)
    assert repair_conversations(empty).count() == 0 and turn_gaps(empty).count() == 0


def test_gaps(spark):
    rows = [(1, 1), (1, 5), (1, 5), (1, None), (2, None), (3, -(1 << 62)), (3, 1 << 62), (None, 4), (None, 6)]
    table = spark.createDataFrame([(c, t, None, None, None, None, None) for c, t in rows], TURNS)
    got = {r.conv_id: r.gaps for r in turn_gaps(table).collect()}
    assert got == {1: 3, 2: 0, 3: (1 << 63) - 1, None: 1}
    assert {r.gaps for r in turn_gaps(table, counted=F.lit(False)).collect()} == {0}


@pytest.mark.parametrize("segment", [7, 512])
def test_long_conversation_in_segments(spark, monkeypatch, segment):
    """One conversation holds most rows; they are cut into segments and joined again."""
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rng = random.Random(segment)
    rows = [(1, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "c!", "", f"t{t}.", f"u{t}"]))
            for t in range(1500)] + [(2, 0, "user", "q?"), (2, 1, "assistant", "a.")]
    closing, texts = _verdicts(spark, rows)
    seen, codes = set(), ""
    for _, _, role, text in rows[:1500]:
        fault = "b" if not text else "d" if (role, text) in seen else ""
        letter = role[0] if role[0] in "sua" else "o"
        codes += fault or (letter if text[-1] in ".!?" else letter.upper())
        seen.add((role, text))
    expected = min((c + repair.CLOSING[s][0], e + repair.CLOSING[s][1]) for s, (c, e) in _walk(codes, 0).items())
    assert (closing[1].cost, closing[1].audit) == expected
    assert (closing[1].blank, closing[1].duplicate) == (codes.count("b"), codes.count("d"))
    assert re.fullmatch("s?(ua)*", "".join(t[0] for t in texts[1]))
    assert closing[2].audit == "KK"


# ---- runs

def _runs(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def _texts(rng, n):
    """Random words, periodic stretches, Fibonacci and Thue-Morse words, broken short periods, squares of those."""
    block = rng.choices("abc", k=rng.randint(2, 9))
    broken = [w for _ in range(8) for w in (block * 30)[:rng.randint(1, n // 4 + 1)]]
    fib, other = "a", "b"
    while len(other) < n:
        fib, other = other, other + fib
    unit = (rng.choices("ab", k=3) * 60)[:rng.randint(31, 120)]
    return [rng.choices("ab", k=n), rng.choices("abcdefgh", k=n), broken, list(other[:n]),
            [str(i.bit_count() % 2) for i in range(n)], unit * 2 + unit[:rng.randint(0, len(unit))] + ["x"] + unit * 2,
            [str(rng.randrange(999)) for _ in range(9)] + [str(i % (n // 3 + 1)) for i in range(n)] + ["z"]]


def test_runs_against_brute_force():
    rng = random.Random(12)
    for n in (0, 1, 12, 40, 130, 300, 500, 700) * 4:
        texts = [[w.encode() for w in t] for t in _texts(rng, n)]
        ids, lengths = _numbered(texts)
        firsts = np.concatenate([[0], np.cumsum(lengths + 1)])
        expected = sorted((s + f, s + m + f, q) for t, f in zip(texts, firsts.tolist()) for s, m, q in _runs(t))
        assert sorted(map(tuple, find_runs(ids, lengths).tolist())) == expected


def test_long_periods():
    rng = random.Random(13)
    for period, length in ((1000, 2000), (4093, 9000), (4094, 8188), (4095, 8190), (1 << 14, 40_000)):
        base = [b"%d" % rng.randrange(50) for _ in range(period)]
        words = [b"x", b"y"] + [base[i % period] for i in range(length)] + [b"z"]
        got = [r for r in find_runs(*_numbered([words])).tolist() if r[2] == period]
        assert got == [[2, 2 + length, period]]


def test_runs_of_odd_rows(spark):
    rows = [(1, None), (None, ""), (2, " \t\n"), (3, "a " * 60_000), (3, "a " * 60_000), (4, "é b " * 12), (5, "w " * 11), (6, "x" * 300_000)]
    docs = spark.createDataFrame([(i, t, *CLASH) for i, t in rows], DOCS)
    got = sorted(((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(docs).collect()))
    assert got == sorted([("1", 0, [], ""), ("None", 0, [], ""), ("2", 0, [], ""), ("3", 60_000, [(0, 60_000, 1)], "a"),
                          ("3", 60_000, [(0, 60_000, 1)], "a"), ("4", 12, [(0, 12, 1)], "é b"),
                          ("5", 11, [], " ".join("w" * 11)), ("6", 1, [], "x" * 300_000)])
    assert periodic_runs(docs.limit(0)).count() == 0


# ---- secrets

def _patterns(text):
    spans = [(*m.span(), 0) for m in re.finditer(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A | re.I)
        if len(m.group(2)) >= 8]
    spans += [(*m.span(), 1) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    spans += [(*m.span(), 2) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(spans, key=lambda s: (s[0], s[2]))


def test_base_spans_against_patterns():
    rng = random.Random(14)
    parts = ["password", "PassWD", "token", "api_key", "apikey", "secret", " ", "  ", '"', "'", ":", "=", "==", "abc", "12345678", "AKIA",
             "AKIAABCDEFGH", "0123abcd" * 4, "deadbeef", "\n", "ſecret", "toKen", "ß", ".", "-", "/", "é", "\r", " ", "--"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        assert base_spans(text) == _patterns(text)
        assert [s for s in secret_spans(text) if s[2] < 3] == _patterns(text)


@pytest.mark.parametrize("text, found", [
    ('DB_PWD="s3cr3tPa55!x"', ["s3cr3tPa55!x"]),
    ("k = 'a8Jd92kLpQ'\nretries = 3\nclientSecret = k", ["a8Jd92kLpQ"]),                   # a constant, followed
    ("k = 'a8Jd92kLpQ'\nk = other()\nclientSecret = k", []),                                # set anew in between
    ('const a: string = "Zx81" + "kk39AbQ";\nauth.bearer = a', ["Zx81", "kk39AbQ"]),        # put together
    ('{"user": "bob", "db_passphrase": "Tr0ub4dor&3xyz"}', ["Tr0ub4dor&3xyz"]),
    ('box["private_key"] = "MIIEvQIBADANBgkqh"', ["MIIEvQIBADANBgkqh"]),
    ("passphrase := `abcDEF123456`", ["abcDEF123456"]), ("tool --pwd Xy7abc99Qw run", ["Xy7abc99Qw"]),
    ("credentials: aB3dE5fG7h", ["aB3dE5fG7h"]),
    ('token_type = "bearerXYZ123"', []), ('pwd = "changeme123"', []), ('pwd = "${VAULT_PWD_1}"', []), ('pwd = getenv("aB3dE5fG7h")', []),
    ("pwd == 'aB3dE5fG7h'", []), ("credential: something easy", []), ('colour = "s3cr3tPa55!x"', []), ('pwd = "unclosed', []),
])
def test_literals_of_sensitive_names(text, found):
    assert [text[s:e] for s, e, k in secret_spans(text) if KINDS[k] == "literal"] == found


def test_values_of_many_pieces_are_followed():
    def literals(text):
        return [text[s:e] for s, e, k in secret_spans(text) if KINDS[k] == "literal"]

    parts = [f"{'aZ'[n % 2]}{n}" for n in range(300)]
    lines = ['k = "b7"'] + [f'k = k + "{p}"' for p in parts]
    for follow in (["clientSecret = k"], ["m = k + k", "m = m + m", "clientSecret = m"], ["k = k + k"] * 3_000 + ["clientSecret = k"]):
        assert literals("\n".join(lines + follow)) == ["b7", *parts]
    assert literals("clientSecret = " + " + ".join(f'"{p}"' for p in parts)) == parts
    # A placeholder where two literals meet, and one over three of them, makes the whole no key.
    for broken in (["chan", "geme"], ["re", "dac", "ted"], ["a ", "b"], ["$", "{V}"]):
        assert literals("\n".join(lines + [f'k = k + "{b}"' for b in broken] + ["k = k + k"] * 9 + ["clientSecret = k"])) == []


def test_joined_pieces_are_judged_as_the_whole():
    rng = random.Random(5)
    parts = ["", "a", "B7", "chan", "geme", "9", "x" * 20, "-", "$", "{", ":", "//", "ſ", "aB3dE5fG7hJ9", " ", ".", "/", "~"]
    for _ in range(5_000):
        pieces = [(0, 0, v, rng.random() < 0.9) for v in rng.choices(parts, rng.choice([[1] * 18, [9] * 6 + [0] * 12]), k=rng.randint(1, 9))]
        cuts = sorted(rng.choices(range(len(pieces) + 1), k=2))
        nested = [*pieces[:cuts[0]], Joined(pieces[cuts[0]:cuts[1]]), *pieces[cuts[1]:]]
        assert Joined(nested).key_likeness() == key_likeness("".join(p[2] for p in pieces), all(p[3] for p in pieces))


def test_scan_of_odd_rows(spark):
    long = "x = 1\n" + 'pwd = "unclosed \\"' * 30_000 + "\n" + "k" * 300_000 + " AKIAABCDEFGHIJKL"
    rows = [(1, None), (None, ""), (2, "😀 token=abcdefgh"), (2, "😀 token=abcdefgh"), (3, long), (4, "a=a+a\n" * 2000)]
    docs = spark.createDataFrame([(i, t, *CLASH) for i, t in rows], DOCS)
    got = sorted((str(r.doc_id), [tuple(s) for s in r.spans]) for r in find_secrets(docs).collect())
    two = ("2", [("assign", 2, 16)])
    assert got == sorted([("1", []), ("None", []), two, two, ("3", [("access", len(long) - 16, len(long))]), ("4", [])])
    assert find_secrets(docs.limit(0)).count() == 0


def test_scan_query_against_patterns(spark):
    docs = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op13_secret_scans"](spark, SF).collect()
    assert len(rows) == len(docs) and any(r.spans for r in rows)
    for r in rows:
        spans = _patterns(docs[r.doc_id] or "")
        base = ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[2] == k for s in spans) for k in range(3)]
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if not s.startswith("literal")] == base.split(",")


def test_all_three_are_registered():
    assert {"op11_conversation_repairs", "op12_periodic_runs", "op13_secret_scans"} <= set(entry_points.queries())
