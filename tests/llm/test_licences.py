from __future__ import annotations

import random
import re

from ledgersync.llm.licences import TEMPLATES, Scanner, op7_licence_scan, scan_licences


def _bigrams(text):
    w = re.findall(r"[^\W_]+", text.lower())
    return {(a, b) for a, b in zip(w, w[1:], strict=False)} if len(w) > 1 else ({(w[0],)} if w else set())


def _brute(text, least=0.8, templates=TEMPLATES):
    """Every passage and every run of words against every template."""
    lines = text.split("\n")
    passages = [(k + 1, 1) for k in range(len(lines))] + [(1, len(lines))]
    start = 0
    for k in range(len(lines) + 1):
        if k == len(lines) or not lines[k].strip():
            if k > start:
                passages.append((start + 1, k - start))
            start = k + 1
    words = [(x, k + 1) for k, part in enumerate(lines) for x in re.findall(r"[^\W_]+", part.lower())]
    pairs = [(x, y) for (x, _), (y, _) in zip(words, words[1:], strict=False)]
    best = {}
    for name, template in templates.items():
        b = _bigrams(template)
        for i in range(len(pairs)):
            held = set()
            for j in range(i, min(len(pairs), i + int((2 - least) / least * len(b) + 1e-9))):
                held.add(pairs[j])
                dice = 2 * len(held & b) / (len(held) + len(b)) if pairs[j] in b else 0
                if dice >= least:
                    best[name] = min(best.get(name, (0, 0, 0)), (-dice, words[i][1], words[j + 1][1] - words[i][1] + 1))
        for first, n in passages:
            a = _bigrams("\n".join(lines[first - 1 : first - 1 + n]))
            dice = 2 * len(a & b) / (len(a) + len(b))
            if dice >= least:
                best[name] = min(best.get(name, (0, 0, 0)), (-dice, first, n))
    return {name: (-d, first, n) for name, (d, first, n) in best.items()}


def test_all_documents_equal_brute_force(spark, sf_dir):
    short = {name: t for name, t in TEMPLATES.items() if len(t) < 70}  # the brute force reads all runs of all texts
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = sorted((r.doc_id, name.split("/")[0], name, *v) for r in rows for name, v in _brute(r.text, templates=short).items())
    got = sorted(map(tuple, op7_licence_scan(spark, sf_dir).collect()))
    assert [r for r in got if r[2] in short] == want and len({r[2] for r in got}) >= 3


def test_notices_inside_lines_and_before_code():
    scanner = Scanner(TEMPLATES, 0.8)
    found = lambda text: {name: (round(v[0], 2), *v[1:]) for name, v in scanner.scan(text).items()}
    assert found("Copyright (c) 2020 Jane Doe. Released under the MIT License.") == {"MIT/notice": (1.0, 1, 1)}
    assert found("This software is released under the MIT License, see LICENSE.txt for details.") == {"MIT/notice": (1.0, 1, 1)}
    w = TEMPLATES["Apache-2.0/header"].split()
    wrapped = "\n".join("# " + " ".join(w[i : i + 8]) for i in range(0, len(w), 8))
    assert found(f"#!/bin/sh\n{wrapped}\nset -e\nexec run --all\n" + "x = compute(y)\n" * 90)["Apache-2.0/header"] == (1.0, 2, wrapped.count("\n") + 1)
    assert found("We license the release of MIT students under the rules of version 2 of the code.") == {}


def test_runs_equal_brute_force():
    rng = random.Random(5)
    scanner = Scanner(TEMPLATES, 0.8)
    for _ in range(12):
        made = []
        for name in rng.sample(sorted(TEMPLATES), 3):
            w = TEMPLATES[name].split()
            for k in range(len(w)):
                if rng.random() < 0.04:
                    w[k] = rng.choice(["thing", "the", "License", ""])
            made += [rng.choice(["foo", "under", "the\n", "\n\n"]) for _ in range(rng.randrange(9))] + w
        text = "".join(x + rng.choice([" ", " ", " ", " ", "\n"]) for x in made + made[: rng.randrange(30)])
        assert scanner.scan(text) == {name: (-v[0] if v[0] < 0 else v[0], *v[1:]) for name, v in _brute(text).items()}


def test_passages_and_hostile_rows(documents):
    mit = TEMPLATES["MIT/text"]
    words = mit.split()
    wrapped = "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))
    texts = [
        wrapped, f"Intro here\n\n{wrapped}\n\nOutro", "  LICENSED under  the apache license; version 2.0!", "Licensed under the Apache License, Version 2.0, or else",
        "licensed under", None, "", " \n\n ", "Released under the MIT License.\n" * 2, "word " * 50_000 + "\nReleased under the MIT License.", "...", mit.replace("Software", "Program"),
    ]
    df = documents([(i, t, "en", "s") for i, t in enumerate(texts)] + [(None, "Licensed under CC BY 4.0", None, None), (3, texts[3], None, None)])
    got = sorted(((r.doc_id, r.licence, r.template, r.dice, r.first_line, r.n_lines) for r in scan_licences(df).collect()), key=repr)
    want = [(i, n.split("/")[0], n, *v) for i, t in [*enumerate(texts), (None, "Licensed under CC BY 4.0"), (3, texts[3])] if t for n, v in _brute(t).items()]
    assert got == sorted(want, key=repr)
    assert {r[0] for r in got} >= {0, 1, 2, 8, 9, None} and not {r[0] for r in got} & {4, 5, 6, 7, 10}
    assert scan_licences(df.limit(0)).count() == 0
    assert Scanner({}, 0.8).scan("a b") == {} and scan_licences(df, {"x": ""}).count() == 0
