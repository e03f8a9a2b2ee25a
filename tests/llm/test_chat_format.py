from __future__ import annotations

import hashlib
import random
from collections import Counter

from adlift.llm.chat_format import MARKERS, format_chats, parse, read_back, render


def test_every_turn_survives():
    rng = random.Random(0)
    parts = [*MARKERS, "\\", "<", "[", "a", " ", "\n", "é", "\\\\", "<s", "s>", "INST]"]
    for _ in range(8000):
        turns = []
        for _ in range(rng.randint(1, 3)):
            role = rng.choice(["user", "assistant", "system", "tool", "", "<s>", "a\\", "\\"])
            turns.append((role, "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))))
        found = parse("".join(render(*t) for t in turns))
        assert [t[:2] for t in found] == turns


def test_plain_text_stays_as_it_is():
    assert render("user", "a < b [0] C:\\x") == "[INST]a < b [0] C:\\x[/INST]"
    assert parse("[INST]a") is None and parse("x[INST]a[/INST]") is None and parse("[INST]a</s>") is None


def brute(rows):
    chats = {}
    for conv, turn, role, text in rows:
        chats.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in chats.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2], render(t[2], t[3])))
        said = [t[3] for t in turns if t[2] == "assistant"]
        every = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        chars = sum(len(render(r, x)) for _, _, r, x in turns)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((conv, len(turns), sha(every), sum(map(len, said)), sha("".join(said)), chars))
    return Counter(out)


def test_table(spark):
    rng = random.Random(3)
    parts = ["</s>", "[INST] ok [/INST]", "<<SYS>>", "word ", "é", "\\", "\n"]
    rows = []
    for conv in [*range(30), None]:
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "system", "tool", None])
            rows.append((conv, turn, role, rng.choice([None, "", "".join(rng.choices(parts, k=6))])))
    rows += [rows[0], (5, None, "user", "first"), (5, 0, "assistant", "tie")]
    rows += [(77, t, "assistant", "long " * 90_000) for t in range(6)]  # several parts
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, part string, rendered int")
    formatted = format_chats(frame.repartition(5))
    assert Counter(map(tuple, read_back(formatted).collect())) == brute(rows)
    assert formatted.where("conv_id = 77").count() > 1
    assert read_back(format_chats(frame.limit(0))).collect() == []
