from __future__ import annotations

import random
import re
from collections import defaultdict

from ledgersync.llm.quotes import op1_reply_chats, reply_ordered

SCHEMA = "conv_id long, turn long, role string, text string, id string, position int"


def _lines(text):
    out = []
    for raw in re.split(r"\r?\n", text or ""):
        marks = re.match(r"(?:[ \t]*>)+", raw)
        out.append([marks[0].count(">") if marks else 0, (raw[marks.end() :] if marks else raw).strip(" ")])
    keep = []
    for k, (level, line) in enumerate(out):
        after = out[k + 1][0] if k + 1 < len(out) else 0
        if not (level == 0 and after > 0 and re.fullmatch(r".{0,200}\b(wrote|said)\s*:", line)):
            keep.append((level, line))
    return keep


def _units(lines):
    norm = lambda s: " ".join(s.split()).lower()
    runs, last = [], None
    for level, line in lines:
        if not line:
            last = None
            continue
        if level != last:
            runs.append((level, []))
        runs[-1][1].append(line)
        last = level
    return {(level, norm(" ".join(r))) for level, r in runs} | {(level, norm(x)) for level, x in lines if x}


def _brute(rows):
    """Every message of each conversation in reply order, by comparing every quote with every earlier message."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn, role, text))
    out = []
    for conv, messages in talks.items():
        made = []
        for turn, role, text in messages:
            lines = _lines(text)
            if not any(level for level, _ in lines):
                made.append([turn, role, text or "", None, 0, 0])
                continue
            quoted, linked, chars = [u for u in _units(lines) if u[0]], 0, defaultdict(int)
            for level, words in quoted:
                turns = [t for t, _, other in messages if t is not None and (0, words) in _units(_lines(other))]
                if turn is not None and turns and min(turns) < turn:
                    linked += 1
                    if level == 1:
                        chars[min(turns)] += len(words)
            own = re.sub(r"\n{3,}", "\n\n", "\n".join(x for level, x in lines if not level)).strip()
            made.append([turn, role, own, max(chars, key=lambda t: (chars[t], t)) if chars else None, len(quoted), linked])
        parent = {}
        for turn, _, _, p, _, _ in made:
            if p is not None:
                parent[turn] = min(p, parent.get(turn, p))

        def root(m, parent=parent):
            if m[3] is None:
                return m[0]
            t = m[0]
            while t in parent:
                t = parent[t]
            return t

        key = lambda m: tuple((x is not None, x) for x in (root(m), m[0], m[1], m[2], m[4], m[5]))
        out += [(conv, k, *m) for k, m in enumerate(sorted(made, key=key))]
    return out


def _rows(df):
    return sorted(((r.conv_id, r.position, r.turn, r.role, r.text, r.parent_turn, r.n_quotes, r.n_linked) for r in df.collect()), key=repr)


def test_all_messages_of_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _rows(op1_reply_chats(spark, sf_dir)) == sorted(_brute(rows), key=repr)


def test_planted_quotes_equal_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for conv in range(12):
        texts = []
        for turn in range(rng.randint(1, 14)):
            own = "\n".join(" ".join(rng.choice("alpha Beta gamma delta eps".split()) for _ in range(rng.randint(3, 7))) + ("\n" if rng.random() < 0.3 else "") for _ in range(rng.randint(1, 4)))
            text = own
            if texts and rng.random() < 0.7:
                source = rng.choice(texts)
                part = rng.choice([source, source.split("\n")[0], source.upper(), source.replace(" ", "   ")])
                quote = "\n".join(rng.choice(["> ", ">", " > "]) + x for x in part.split("\n"))
                text = rng.choice([f"Bob wrote:\n{quote}\n{own}", f"{own}\n{quote}", f"{quote}\n\n\n\n{own}\n> not found anywhere {turn}"])
            texts.append(text)
            rows.append((conv, turn, rng.choice(["user", "assistant"]), text))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    got, want = _rows(reply_ordered(df)), sorted(_brute(rows), key=repr)
    assert got == want
    assert sum(r[5] is not None for r in got) > 20 and max(r[7] for r in got) > 2


def test_hostile_rows(spark):
    long = "\n".join(f"line {i}" for i in range(3000))
    rows = [
        (1, 0, "user", long), (1, 1, "user", "> " + long.replace("\n", "\n> ") + "\nyes"), (1, 2, None, ">> line 7\n> yes\nso\r\n"), (1, 2, None, ">> line 7\n> yes\nso\r\n"),
        (1, None, "user", "> yes\nnull turn"), (1, 3, "user", None), (1, 4, "user", ""), (None, 0, "a", "q"), (None, 1, "b", "> q\nr"), (2, 5, "a", "> q"), (2, 5, "a", ">"), (2, 6, "b", "a > b"),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = _rows(reply_ordered(df))
    assert got == sorted(_brute(rows), key=repr)
    assert [r[5] for r in got if r[0] is None and r[2] == 1] == [0]
    assert reply_ordered(df.limit(0)).count() == 0


def test_texts_and_roles_with_equal_beginnings(spark):
    long = "x" * 64
    roles = [None, "", "a", long, long + "a", long + "b", long + "bb"]
    rows = [(1, 5, role, text) for role in roles for text in (long, long + "z", long + "a", "b", "é" * 70, "é" * 64 + "a", None, "b")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    assert _rows(reply_ordered(df)) == sorted(_brute(rows), key=repr)
