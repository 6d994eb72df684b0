import hashlib
import random
import re
import string
from collections import Counter

from helpers import ODD, documents, rows

from ledgerloom.llm import secret_scan

ASSIGN, ACCESS, HEX = re.compile(secret_scan.ASSIGN), re.compile(secret_scan.ACCESS), re.compile("[0-9a-f]+")


def base(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(spans)


def joined(spans):
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)


TEXTS = ["password=abc", "secret=token: abcdefgh", "API_KEY = 'abcdef' apikey:\"x.y/z+w=\" Token=é",
         "\U0001f600é passwd: hunter2hunter2 AKIA" + "A1" * 8 + " AKIAAKIA AKIA" + "B" * 40,
         "0123456789abcdef01234567 " + "deadbeef" * 6 + "X" + "a" * 24, "token=AKIA" + "Z9" * 9,
         "password=secret=token=abcdefgh", "password : = x", "tokentoken=abcdef token\n=abcdef",
         "AKIA" + "A" * 16 + "a" * 30, "secret  =  " + "0f" * 14]


def test_base_spans_match_python(spark):
    pairs = list(enumerate(TEXTS)) + [(None if i is None else i + 100, t) for i, t in ODD] + [
        (r["doc_id"] + 1000, r["text"]) for r in rows("documents")] + [(5000, "password=abcdef " * 3000)]
    got = Counter()
    for r in secret_scan.scan(documents(spark, pairs, clashes=True)).collect():
        own = ",".join(s for s in r["spans"].split(",") if not s.startswith("random"))
        got[(r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"], own)] += 1
    want = Counter()
    for i, t in pairs:
        s = base(t or "")
        n = [sum(k == j for _, k, _ in s) for j in range(3)]
        want[(i, *n, hashlib.sha256(joined(s).encode()).hexdigest(), joined(s))] += 1
    assert got == want


def test_battery_finds_random_runs_and_leaves_prose(spark):
    rng = random.Random(7)
    letters = string.ascii_letters + string.digits
    keys = ["".join(rng.choice(letters) for _ in range(40)) for _ in range(30)]
    keys += ["".join(rng.choice(letters + "+/") for _ in range(44)) for _ in range(30)]
    words = ["alpha", "Number", "value", "list", "Index", "table", "count", "Window", "result", "frame"]
    names = ["".join(rng.choice(words) for _ in range(6)) for _ in range(300)] + ["x" * 40, "xy" * 30, "-" * 60,
                                                                                  "abcdefghijklmnopqrstuvwxyz0123"]
    pairs = [(i, f"see {k} here") for i, k in enumerate(keys + names)]
    got = {r["doc_id"]: r["spans"] for r in secret_scan.scan(documents(spark, pairs)).collect()}
    found = [i for i, s in got.items() if s]
    assert sum(i < len(keys) for i in found) >= 0.9 * len(keys)
    assert all(got[i] == f"random:4:{4 + len(keys[i])}" for i in found if i < len(keys))
    assert sum(i >= len(keys) for i in found) <= 1


WORDS = ["alpha", "Number", "value", "list", "Index", "table", "count", "Window", "result", "frame"]


def found_spans(spark, tokens, forms, prose):
    """Share of the tokens found at their exact place in any of the forms, and the prose texts with spans."""
    pairs, want = [], {}
    for i, token in enumerate(tokens):
        form = forms[i % len(forms)]
        start = form.index("{}")
        pairs.append((i, form.replace("{}", token)))
        want[i] = f"random:{start}:{start + len(token)}"
    pairs += [(len(tokens) + i, x) for i, x in enumerate(prose)]
    got = {r["doc_id"]: r["spans"] for r in secret_scan.scan(documents(spark, pairs)).collect()}
    return sum(got[i] == w for i, w in want.items()) / len(want), [pairs[i][1] for i, s in got.items()
                                                                   if s and i not in want]


def test_battery_takes_values_after_an_equals_sign(spark):
    rng = random.Random(8)
    letters = string.ascii_letters + string.digits
    keys = ["".join(rng.choice(letters) for _ in range(40)) + "=" * (i // 6 % 3) for i in range(90)]
    forms = ["AWS_SECRET_ACCESS_KEY={}", "private_key={}", "https://host.example/f?sig={}&x=1",
             "HOST=db.example\nSIGNING={}\nPORT=80", "<a href=\"{}\">", "see a=b=={} there"]
    prose = [f"see {''.join(rng.choice(WORDS) for _ in range(6))}={rng.choice(WORDS)}" for _ in range(300)]
    share, wrong = found_spans(spark, keys, forms, prose)
    assert share >= 0.9 and len(wrong) <= 1


ONE_CASE = [string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits,
            string.ascii_lowercase + "234567", string.ascii_lowercase, string.ascii_uppercase]


def test_battery_infers_the_case(spark):
    rng = random.Random(9)
    keys = ["".join(rng.choice(a) for _ in range(n)) for a in ONE_CASE for n in (40, 64, 96, 160) for _ in range(15)]
    mixed = ["".join(rng.choice(WORDS) for _ in range(rng.randint(4, 12))) for _ in range(300)]
    prose = [f"see {x} here" for x in mixed + [x.lower() for x in mixed] + [x.upper() for x in mixed]]
    prose += [f"see {x} here" for x in ("internationalization", "INTERNATIONALIZATION", "x" * 40, "XY" * 30,
                                        "abcdefghijklmnopqrstuvwxyz", "section12paragraph34line56")]
    share, wrong = found_spans(spark, keys, ["see {} here"], prose)
    assert share >= 0.97 and len(wrong) <= 3


def test_empty_and_native(spark):
    assert secret_scan.scan(documents(spark, [])).count() == 0
    plan = secret_scan.scan(documents(spark, [(1, "password=abcdef")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
