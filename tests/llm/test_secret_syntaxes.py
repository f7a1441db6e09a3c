"""A corpus of syntaxes: which literals the assignment reader finds, and which it leaves."""

import random
import time

import pytest

from railpulse.llm.secrets import Look, Reader, literal_score, pairs, spans_of

KEY = "Zx81Qw92Er73Ty64"


def added(text):
    return [text[a:b] for kind, a, b, _ in spans_of(text) if kind == "literal"]


@pytest.mark.parametrize(
    ("text", "secrets"),
    [
        (f"<credential>{KEY}</credential>", [KEY]),
        (f"<c><db.password type='x'>\n  {KEY}\n</db.password></c>", [KEY]),
        (f"<credential><![CDATA[{KEY}]]></credential>", [KEY]),
        (f'<add key="DbPwd" value="{KEY}"/>', [KEY]),
        (f'<property name="db.pwd">{KEY}</property>', [KEY]),
        (f"pwd: |\n  {KEY}\n  Ab12Cd34\nuser: x", [KEY, "Ab12Cd34"]),
        (f"a:\n  pwd: >-\n\n    {KEY}\n  user: someone", [KEY]),
        ("private_key: |\n  -----BEGIN EC PRIVATE KEY-----\n  MHcCAQEEIB9q\n  -----END EC PRIVATE KEY-----\n", ["MHcCAQEEIB9q"]),
        (f"pwd = \\\n    '{KEY}'", [KEY]),
        (f"pwd = (\n    'Zx81Qw92'\n    'Er73Ty64'\n)", ["Zx81Qw92", "Er73Ty64"]),
        (f"const pwd =\n  '{KEY}';", [KEY]),
        (f"os.environ['DB_PWD'] = '{KEY}'", [KEY]),
        (f"pwd = f'{KEY}'", [KEY]),
        ("part = 'Zx81Qw92'\npwd = f'{part}-Er73'", ["Zx81Qw92", "-Er73"]),
        (f'pwd = """{KEY}"""', [KEY]),
        (f"pwd: str = '{KEY}'", [KEY]),
        (f"run --pwd {KEY} --verbose", [KEY]),
        (f"run --pwd={KEY}", [KEY]),
        (f'#define DB_PWD "{KEY}"', [KEY]),
        (f'config.setPwd("{KEY}")', [KEY]),
        (f'map.put("pwd", "{KEY}")', [KEY]),
        (f"BASE={KEY}\nPWD=$BASE", [KEY]),
        (f'BASE={KEY}\nexport DB_PWD="${{BASE}}"', [KEY]),
        ("$pwd = 'Zx81Qw92' . 'Er73Ty64';", ["Zx81Qw92", "Er73Ty64"]),
        ("pwd := \"Zx81Qw92\" +\n  \"Er73Ty64\"", ["Zx81Qw92", "Er73Ty64"]),
        ("pwd = 'Zx81\\'Qw92'", ["Zx81\\'Qw92"]),
        ("pwd = '" + KEY * 8192 + "'", [KEY * 8192]),
    ],
)
def test_found(text, secrets):
    assert added(text) == secrets


@pytest.mark.parametrize(
    "text",
    [
        "pwd_hash = compute_digest(x)",
        "private_key = base64(data1)",
        "signing_key = keys[index1]",
        "pwd = config.db1.secrets2",
        "pwd = user_input",
        "pwd = compute9() + other9()",
        "<credential>${env.DB_PWD}</credential>",
        "<a><credential></credential></a>",
        "pwd:\n  'other': value",
        "pwd: |\nuser: Zx81Qw92Er73Ty64",
        'pwd = """never closed Zx81Qw92',
        "if pwd == 'Zx81Qw92Er73': pass",
        "pwd = f'{first}{second}'",
        "x = 1\n\n\n",
    ],
)
def test_left(text):
    assert added(text) == []


def test_constants_end_with_their_block():
    text = "def f():\n    base = 'Zx81Qw92Er73'\n\ndef g():\n    pwd = base\n"
    assert added(text) == []
    outer = "base = 'Zx81Qw92Er73'\ndef f():\n    base = 'one'\npwd = base\n"
    assert added(outer) == ["Zx81Qw92Er73"]
    same = "def f():\n    base = 'Zx81Qw92Er73'\n    if x:\n        pwd = base\n"
    assert added(same) == ["Zx81Qw92Er73"]


def test_looks_add_up():
    rng = random.Random(3)
    for _ in range(300):
        whole = "".join(rng.choice("xX*aZ09$-{}é%<>") for _ in range(rng.randint(0, 150)))
        cut = rng.randint(0, len(whole))
        assert Look.of(whole[:cut]).then(Look.of(whole[cut:])) == Look.of(whole)
    assert literal_score("<" + KEY * 9 + ">") == 0 and literal_score(KEY * 9) > 0.9


def test_every_literal_gets_its_best_score():
    text = "a = 'Zx81Qw92'\nsalt = a\npassphrase = salt + 'Er73Ty64'"
    scores = {text[a:b]: score for _, a, b, score in spans_of(text)}
    assert scores["Zx81Qw92"] == scores["Er73Ty64"] > 0.9
    assert [p[:2] for p in pairs(text)][-1] == ("passphrase", "Zx81Qw92Er73Ty64")


@pytest.mark.parametrize(
    "text",
    [
        "pwd = pwd + 'x1'\n" * 40_000,
        "a='x1y2z3'\n" + "a = a + a\n" * 2_000,
        "<a " * 100_000,
        "<a><![CDATA[" * 60_000,
        "pwd: |\n  x\n" * 40_000,
        "".join("  " * i + "pwd: |\n" for i in range(700)),
        '{"k":"v",' * 100_000,
        'a="""b ' * 60_000,
        "f(" * 200_000,
        "--a " * 100_000,
        "pwd = (" * 60_000,
        "a = f'" + "{" * 200_000 + "'",
        "a: " + "b " * 200_000,
        "a = '\\" * 60_000,
        "x" + "\t" * 200_000 + "\\\n" * 50_000,
    ],
)
def test_cost_follows_the_text(text):
    started = time.perf_counter()
    spans_of(text)
    assert time.perf_counter() - started < 15


def test_random_texts_never_fail():
    rng = random.Random(5)
    bits = ["pwd", "key", "=", ":", "(", ")", "'", '"', '"""', "`", "f", "{", "}", "$", "\\", "\n", "  ", "|", "+", ".",
            "<", ">", "</", "/>", "Zx81Qw92", "é", "--", "#define ", ",", "set", "[", "]", "<![CDATA[", "]]>"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        reader = Reader(text)
        for a, b, score in reader.scores():
            assert 0 <= a < b <= len(text) and 0.5 <= score <= 1
