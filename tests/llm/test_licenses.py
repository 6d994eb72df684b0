import random

from helpers import LONG, ODD, documents

from ledgerloom.llm import licenses
from ledgerloom.llm.licenses import DICE, TEMPLATES, Templates, bigrams, matches, scan, units

FULL = {name: texts[-1] for name, texts in TEMPLATES.items()}


def test_every_template_matches_itself():
    t = Templates()
    for name, texts in TEMPLATES.items():
        for text in texts:
            got = matches(f"Some prose before it.\n{text.upper()}\nand prose after it", t)
            assert (name, 1.0) in [(n, d) for n, d, _, _ in got], text


def test_bounds_never_prune_a_match():
    """Against all templates, without bounds or index."""
    t = Templates()
    for text in FULL.values():
        words = text.split()
        for cut in range(2, len(words) + 1, 3):
            unit = " ".join(words[:cut]) + " extra words here" * (cut % 3)
            grams = bigrams(unit)
            scores = [(-2 * len(grams & bigrams(x)) / (len(grams) + len(bigrams(x))), n)
                      for n, texts in TEMPLATES.items() for x in texts] if grams else []
            best = min(scores, default=(0, ""))
            assert t.best(grams) == ((-best[0], best[1]) if -best[0] >= DICE else None)


def test_licence_over_several_lines():
    words = FULL["MIT"].split()
    wrapped = "\n".join(" ".join(words[i:i + 9]) for i in range(0, len(words), 9))
    text = f"Intro line of a file.\n\n{wrapped}\n\nThe rest of it."
    got = [m for m in matches(text, Templates()) if m[0] == "MIT"]
    assert got and text[got[0][2]:got[0][3]] == wrapped


def test_complete_texts_headers_and_notices_in_prose():
    t = Templates()
    for name in ("BSD-2-Clause", "BSD-3-Clause", "MIT", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0", "Apache-2.0"):
        words = max(TEMPLATES[name], key=len).split()
        text = "\n\n".join(" ".join(words[i:i + 40]) for i in range(0, len(words), 40))
        got = matches(f"Copyright (c) 2020 Somebody\n\n{text}\n\nIntroduction to the rest of the file.", t)
        assert [(n, d) for n, d, _, _ in got] == [(name, 1.0)]
    line = "The code was written in May and is Licensed under the Apache License, Version 2.0. See docs."
    assert [(n, d, line[a:b]) for n, d, a, b in matches(line, t)] == [
        ("Apache-2.0", 1.0, "Licensed under the Apache License, Version 2.0")]
    header = FULL["GPL-3.0"].replace("General", "Lesser General")
    assert [m[0] for m in matches(header, t)] == ["LGPL-3.0"]


def test_units():
    text = "a b\nc d\n\n\ne f"
    assert [text[a:b] for a, b in units(text)] == ["a b", "c d", "e f", "a b\nc d", text]
    assert list(units("")) == [] and list(units(" \n ")) == [] and list(units("one")) == [(0, 3)]


def test_scan(spark):
    pairs = ODD + [(50, f"{LONG}\nLicensed under the Apache License, Version 2.0.\nmore"), (51, "Released under MIT"),
                   (52, "The license of this is a secret")]
    got = {}
    for r in scan(documents(spark, pairs, clashes=True)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(pairs)
    hit = got[50][0]
    assert (hit["n_matches"], hit["best_license"], hit["best_dice"]) == (1, "Apache-2.0", 1.0)
    assert hit["spans"][0]["start"] == len(LONG) + 1
    assert all(r["n_matches"] == 0 and r["best_license"] is None for i, rs in got.items() if i != 50 for r in rs)
    assert scan(documents(spark, [])).count() == 0


def test_windows_against_brute_force():
    """Every start's best end, over all ends, for templates that share words and texts that repeat them."""
    rnd = random.Random(7)
    texts = {"A": ["one two three four five six seven"], "B": ["one two six seven eight one two"], "C": ["nine ten"]}
    templates = licenses.Templates(texts)
    pool = "one two three four five six seven eight nine ten x".split()
    for _ in range(150):
        words = []
        for _ in range(rnd.randrange(7)):
            words += rnd.choice([texts["A"][0].split(), texts["B"][0].split(), [rnd.choice(pool) for _ in range(4)]])
            if words and rnd.random() < 0.3:
                words[rnd.randrange(len(words))] = "edit"
        text = " ".join(words)
        at = [m.start() for m in licenses.WORDS.finditer(text)]
        want = set()
        for name, (template,) in texts.items():
            g = licenses.bigrams(template)
            for s in range(len(words) - 1):
                if (words[s], words[s + 1]) not in g:
                    continue
                scores = []
                for e in range(s + 2, len(words) + 1):
                    got = set(zip(words[s:e], words[s + 1:e], strict=False))
                    scores.append((2 * len(got & g) / (len(got) + len(g)), -e))
                best, e = max(scores)
                if best >= licenses.DICE:
                    want.add((round(best, 9), name, at[s], at[-e - 1] + len(words[-e - 1])))
        got = {(round(d, 9), name, a, b) for d, name, _, a, b in templates.windows(text)}
        assert got == want, text


def test_many_equal_licences_in_linear_time():
    import time

    notice = licenses.TEMPLATES["MIT"][0]
    templates, took = licenses.Templates(), []
    for n in (20, 200):
        start = time.perf_counter()
        found = licenses.matches("\n\n".join([notice] * n), templates)
        took.append(time.perf_counter() - start)
        assert [x[0] for x in found] == ["MIT"] * len(found) and found
    assert took[1] < 40 * took[0]
