"""The secret ledger against Python's re."""

import hashlib
import re
import time

import pytest
from pyspark.sql import functions as F

from tillwise import scratch
from tillwise.llm import secrets
from tillwise.llm.secrets import Rule

# The patterns as the contract words them, with their least lengths.
PATTERNS = {
    "assign": (r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
TEXTS = [
    None, "", "nothing here", "password = hunter2x", "PassWord:'abcdefg' token=ab secret=abcdefg",
    "secret=token:abcdef", "token==token", "api_key: 'x' apikey=\"1234567\"", "é日本 passwd=ééé passwd= abc_def-1",
    "AKIA" + "Z9" * 8, "AKIA" + "Z" * 15, "xAKIAAKIA" + "Q" * 14 + " AKIA", "0123456789abcdef01234567",
    "0123456789abcdef0123456", "g" + "deadbeef" * 4 + "é" + "0" * 30, "token=" + "deadbeef" * 4,
    "a😀b secret: " + "x" * 5000, "=" * 300, "secret=abcdef" * 3, "KKey apiKey=abcdefg",
    "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 15, "abc " * 30_000 + "password=qwertyu"]


def base(text):
    out = []
    for at, (kind, (pattern, part, least)) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            if len(m[part]) >= least:
                out.append((m.start(), at, f"{kind}:{m.start()}:{m.end()}", kind))
    out.sort()
    return [x[3] for x in out], ",".join(x[2] for x in out)


def table(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)],
                                 "doc_id long, text string, spans string, blob string")


def test_base_spans_equal_python(spark):
    rows = secrets.secret_scan(table(spark, TEXTS), scratch.new_folder(spark, "ledger")).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        kinds, said = base(TEXTS[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [kinds.count(k) for k in PATTERNS]
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))


def test_added_rules_find_their_kinds(spark):
    rows = {r.doc_id: r.spans for r in
            secrets.secret_scan(table(spark, TEXTS), scratch.new_folder(spark, "ledger")).collect()}
    assert rows[TEXTS.index("-----BEGIN RSA PRIVATE KEY-----")] == "pem:0:31"
    assert rows[TEXTS.index("ghp_" + "a1" * 15)].startswith("forge:0:34")


def test_only_unseen_pairs_are_scanned(spark):
    ledger = scratch.new_folder(spark, "ledger")
    rules = (Rule("x", "x+", 0, 2), Rule("y", "y+", 0, 1))

    def scan(texts, now):
        got = secrets.scan(table(spark, texts), "doc_id", "text", ledger, now).collect()
        return sorted((r.path, sorted((k, [tuple(s) for s in v]) for k, v in (r.spans or {}).items())) for r in got)

    def held():
        return secrets.read_ledger(spark, ledger).count()

    assert scan(["xx y", "xx y", "z"], rules) == [(0, [("x@1", [(0, 2)]), ("y@1", [(3, 4)])])] * 0 + [
        (0, [("x@1", [(0, 2)]), ("y@1", [(3, 4)])]), (1, [("x@1", [(0, 2)]), ("y@1", [(3, 4)])]), (2, [])]
    assert held() == 4
    assert scan(["xx y", "new yy"], rules)[1] == (1, [("y@1", [(4, 6)])])
    assert held() == 6
    later = (Rule("x", "x", 0, 1, version=2), rules[1])
    assert scan(["xx y"], later) == [(0, [("x@2", [(0, 1), (1, 2)]), ("y@1", [(3, 4)])])]
    assert held() == 7


def test_empty_table_and_null_paths(spark):
    ledger = scratch.new_folder(spark, "ledger")
    assert secrets.secret_scan(table(spark, []), ledger).collect() == []
    df = spark.createDataFrame([(None, "password=abcdefg"), (None, "password=abcdefg"), (None, "other")],
                               "doc_id long, text string")
    assert sorted(r.n_assign for r in secrets.secret_scan(df, ledger).collect()) == [0, 1, 1]


def test_the_scan_is_built_in_expressions_only(spark):
    plan = secrets.scan(table(spark, TEXTS), "doc_id", "text", scratch.new_folder(spark, "ledger"))
    said = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", said)


@pytest.mark.parametrize("text", ["aaXaaXXaa", "", "X", "XX", "aXa"])
def test_spans_of_touching_matches(spark, text):
    rule = Rule("k", "X", 0, 1)
    matched = spark.range(1).select(F.lit("b").alias("blob"), F.lit(rule.name).alias("rule"),
                                    secrets.matches(F.lit(text), rule).alias("matches"))
    got = secrets.spans(matched, (rule,)).first().spans
    assert [tuple(x) for x in got] == [m.span() for m in re.finditer("X", text)]


def test_many_findings_take_time_in_proportion(spark):
    def seconds(n):
        best = None
        for _ in range(2):
            df = table(spark, ["".join(f"{i:024x} " for i in range(n))])
            start = time.perf_counter()
            row = secrets.secret_scan(df, scratch.new_folder(spark, "ledger")).first()
            best = min(best or 1e9, time.perf_counter() - start)
            assert row.n_hex == n and row.spans.endswith(f"hex:{25 * (n - 1)}:{25 * n - 1}")
        return best

    # Eight times the findings: the square would take 64 times as long.
    small = seconds(8_000)
    assert seconds(64_000) < 8 * small
