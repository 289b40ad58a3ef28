import random
import re
import textwrap

from tourney.llm import licenses

SCHEMA = "doc_id long, text string, score string, license int"


def by_brute_force(text, threshold=licenses.THRESHOLD):
    """Every span that `parts` may name, against every template."""
    best = None
    for start, end in set(licenses.parts(text)):
        grams = licenses.bigrams(licenses.normalised(text[start:end]))
        for name, body in licenses.TEMPLATES:
            other = licenses.bigrams(licenses.normalised(body))
            if grams:
                score = 2 * len(grams & other) / (len(grams) + len(other))
                if score >= threshold and (best is None or (-score, name) < best):
                    best = (-score, name)
    return (best[1], round(-best[0], 6)) if best else (None, 0.0)


def texts():
    bodies = [body for _, body in licenses.TEMPLATES]
    out = [None, "", "no licence here", "MIT", "license license license"]
    for body in bodies:
        flat = re.sub(r"\s+", " ", body)
        out += [flat, flat.upper(), f"Some words first.\n{flat}\nAnd some after it.",
                f"Intro. {flat} Outro here.", f"a b\n\n{body}\n\nc d", flat.replace(" the ", " a ")]
    out += ["x " * 50_000 + "\nReleased under the MIT License.", bodies[0] + "\n" + bodies[4]]
    return out


def test_best_match_of_brute_force(spark):
    rows = [(i % 60, t, "?", 0) for i, t in enumerate(texts())]
    found = licenses.scan_licenses(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    assert len(found) == len(rows)
    for row, (_, text, _, _) in zip(found, rows, strict=True):
        assert (row.license, round(row.score, 6)) == by_brute_force(text or "")
        for part in row.found:
            assert 0 <= part.start < part.end <= len(text) and part.score >= licenses.THRESHOLD


def test_size_bounds_lose_nothing():
    low, high = licenses.size_bounds(10, 0.8)
    for size in range(1, 40):
        reachable = 2 * min(size, 10) / (size + 10) >= 0.8
        assert reachable == (low <= size <= high)


def test_empty_table(spark):
    assert licenses.license_summary(spark.createDataFrame([], SCHEMA)).count() == 0


def long_document(notice):
    """The notice between sentences that share nothing with it."""
    filler = " ".join(f"word{i} other{i} thing{i}." for i in range(400))
    return f"{filler}\n\n{notice}\n\n{filler}"


def test_notices_in_any_layout():
    scanner = licenses.Scanner(licenses.TEMPLATES + licenses.MORE_TEMPLATES, licenses.THRESHOLD)
    bodies = {}
    for name, body in licenses.TEMPLATES + licenses.MORE_TEMPLATES:
        flat = re.sub(r"\s+", " ", body)
        bodies[name] = max(bodies.get(name, ""), flat, key=len)
    mit = bodies["MIT"].replace(" The above", "\n\nThe above").replace(
        " THE SOFTWARE IS", "\n\nTHE SOFTWARE IS")
    isc = bodies["ISC"].replace(" THE SOFTWARE IS", "\n\nTHE SOFTWARE IS")
    layouts = [("MIT", mit), ("ISC", isc)]
    for name in ("MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "LGPL-2.1",
                 "LGPL-3.0", "AGPL-3.0", "GPL-2.0", "GPL-3.0", "Unlicense"):
        lines = textwrap.wrap(bodies[name], 60)
        layouts.append((name, "some words before it\n" + "\n".join(lines) + "\nand some after"))
        layouts.append((name, "/*\n * Copyright of us.\n * " + "\n * ".join(lines) + "\n *\n */"))
        layouts.append((name, "Words before it. " + bodies[name] + " Words " + "after it " * 5))
    for name, notice in layouts:
        text = long_document(notice)
        found = scanner.scan(text)
        best = min(found, key=lambda f: (-f["score"], f["license"]))
        assert best["license"] == name and best["score"] > 0.9, (name, notice, found)
        assert text[best["start"] : best["end"]] in text and best["start"] >= text.index(notice[:9])
    assert [f["license"] for f in scanner.scan(long_document(f"{mit}\nx y z\n{isc}"))] == ["ISC", "MIT", "ISC"]


def test_runs_of_brute_force():
    """Every run of words against one template."""
    rng = random.Random(4)
    body = "a b c d e f g h"
    grams = licenses.bigrams(body.split())
    for _ in range(300):
        words = [rng.choice("abcdefghx") for _ in range(8)]
        words[rng.randrange(8):0] = body.split()[rng.randrange(3) : rng.randrange(5, 9)]
        words += rng.choice([[], ["a", "b"] * 6])
        text = " ".join(words)
        best = 0.0
        for start in range(len(words)):
            for end in range(start + 2, len(words) + 1):
                run = licenses.bigrams(words[start:end])
                best = max(best, 2 * len(run & grams) / (len(run) + len(grams)))
        found = licenses.Scanner([("x", body)], 0.7)._runs(text, [0], [])
        assert max((f["score"] for f in found), default=0.0) == (best if best >= 0.7 else 0.0)


def test_sql_keeps_its_templates():
    assert all(body.replace("'", "''") in licenses.ORACLE_SQL for _, body in licenses.TEMPLATES)
    assert "Redistribution" not in licenses.ORACLE_SQL
