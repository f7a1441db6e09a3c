import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from railpulse.llm.queries import REGISTRY
from railpulse.llm.secrets import find_secrets, literal_score, name_score, pairs, spans_of

SF = "/root/testdata/sf0.001"
# Written apart from the operator: the three base kinds in their order.
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""
)


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = REGISTRY["op1_secret_scan"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = brute(docs[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(
            sum(s[0] == k for s in base) for k in ("assign", "access", "hex")
        )
        assert [s for s in r.spans.split(",") if s and not s.startswith("literal")] == (
            joined.split(",") if joined else []
        )


@pytest.mark.parametrize("seed", range(5))
def test_base_spans_of_random_texts(seed):
    rng = random.Random(seed)
    bits = ["password", "TOKEN", "Api_Key", "apikey", "ſecret", "=", ":", " ", '"', "'", "AKIA", "ABCD1234",
            "0123456789abcdef", "é", "\n", "abc.def-", "x"]
    for _ in range(300):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert [s[:3] for s in spans_of(text) if s[0] != "literal"] == brute(text), text


@pytest.mark.parametrize(
    ("text", "secret"),
    [
        ('db_pass = "hunter2Xk9!q"', "hunter2Xk9!q"),
        ('key_part = "aB3dE5gH"\nprivate_key = key_part + "7iJ9kL1m"', "aB3dE5gH"),
        ('{"clientCredential": "Zx81-Qw92-Er73"}', "Zx81-Qw92-Er73"),
        ("AUTH_BEARER => Zx81Qw92Er73Ty64", "Zx81Qw92Er73Ty64"),
    ],
)
def test_assignments_add_spans(text, secret):
    added = [text[a:b] for kind, a, b, _ in spans_of(text) if kind == "literal"]
    assert secret in added


@pytest.mark.parametrize(
    "text",
    [
        'db_pass = "changeme"',
        'auth_url = "aB3dE5gH7iJ9"',
        'title = "aB3dE5gH7iJ9kL1m"',
        "private key: a plain sentence",
        "time 10:45 and http://host:8080/x=y",
    ],
)
def test_harmless_assignments(text):
    assert not [s for s in spans_of(text) if s[0] == "literal"]


def test_constants_are_followed():
    found = {name: value for name, value, _ in pairs("a = 'one'\nb = a + 'two'\nc = b")}
    assert found == {"a": "one", "b": "onetwo", "c": "onetwo"}


@pytest.mark.parametrize(
    "text",
    ["a" * 400_000 + " x=1", "k='" + "v" * 60_000 + "'\nx=" + "k+" * 20_000, '"' * 200_000 + "=", "a = b\n" * 60_000,
     "password = abcdef\n" * 40_000, "name " + " " * 300_000 + ":"],
)
def test_long_texts_take_linear_time(text):
    started = time.perf_counter()
    spans_of(text)
    assert time.perf_counter() - started < 20


def test_scores():
    assert name_score("DB_PASSWORD") == 1 and name_score("tokenCount") == 0
    assert literal_score("short") == 0 and literal_score("aB3dE5gH7iJ9") > 0.8


def test_odd_rows(spark, documents):
    docs = documents(
        [(1, None), (2, ""), (2, ""), (None, "password=abcdef"), (3, "x " * 300_000 + "password=abcdef")]
    )
    rows = find_secrets(docs).select("doc_id", F.size("spans").alias("n")).collect()
    assert sorted((r.doc_id or 0, r.n) for r in rows) == [(0, 1), (1, 0), (2, 0), (2, 0), (3, 1)]
    assert find_secrets(docs.limit(0)).count() == 0
