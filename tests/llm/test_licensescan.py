from __future__ import annotations

import random
import re

from tidewarden.llm.licenses import TEMPLATES
from tidewarden.llm.licensescan import classes_of, scan_licenses, shingles_of


def brute_force(text: str) -> dict[int, tuple[float, int, int]]:
    """Best window of every notice, over all windows."""
    words = re.findall(r"[^\W_]+", (text or "").lower())
    parts = [" ".join(words[i : i + 5]) for i in range(len(words) - 4)]
    out = {}
    for c in classes_of(TEMPLATES):
        for n in c.notices:
            own, best = set(n.shingles), None
            for start in range(0, len(parts), c.step):
                inside = parts[start : start + c.size]
                share = len(own & set(inside)) / len(own)
                if share >= 0.8 - 1e-9 and (best is None or share > best[0]):
                    at = [start + i for i, s in enumerate(inside) if s in own]
                    best = (share, at[0], at[-1] + 4)
            if best:
                out[n.number] = best
    return out


def test_bands_keep_their_promise():
    for c in classes_of(TEMPLATES):
        for n in c.notices:
            size = len(n.shingles)
            need = -(-8 * size // 10)
            least = need / (c.size + size - need)
            assert (1 - least**2) ** c.bands <= 1e-6
            assert c.size >= size + c.step


def test_equals_brute_force_on_whole_and_damaged_notices(spark, docs):
    rng = random.Random(5)
    filler = [f"w{i}" for i in range(50)]
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    for i in range(120):
        _, notice = TEMPLATES[i % len(TEMPLATES)]
        words = notice.split(" ")
        for _ in range(i // len(TEMPLATES)):
            words[rng.randrange(len(words))] = rng.choice(filler)
        around = [" ".join(rng.choices(filler, k=rng.randrange(60))) for _ in range(2)]
        rows.append((10_000 + i, f"{around[0]}\n# {' '.join(words)} {around[1]}"))
    got: dict = {}
    for r in scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        assert r["license"] == TEMPLATES[r["notice"]][0]
        got.setdefault(r["doc_id"], {})[r["notice"]] = (r["containment"], r["first_word"], r["last_word"])
    want = {i: found for i, text in rows if (found := brute_force(text))}
    assert got == want
    assert len(want) > 30


def test_odd_rows_and_empty_input(odd, empty, spark):
    assert scan_licenses(odd).count() == 0
    assert scan_licenses(empty).count() == 0
    assert scan_licenses(odd, [("x", "too short")]).count() == 0
    notice = "Released under the MIT License."
    found = scan_licenses(spark.createDataFrame([(1, notice), (1, notice), (None, notice + " " + notice)], "doc_id bigint, text string"))
    assert sorted((str(r["doc_id"]), r["license"], r["first_word"]) for r in found.collect()) == [("1", "MIT", 0), ("None", "MIT", 0)]
    assert len(shingles_of(notice)) == 1
