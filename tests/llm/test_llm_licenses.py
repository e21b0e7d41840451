import math
import re

import pyarrow as pa
from llm_brute import SF

from strata.llm.license_scan import Settings, align, bare_words, index_of, matches, scan
from strata.llm.license_templates import DISTINCT, TEMPLATES
from strata.llm.queries import op6_license_scan


def bare(text):
    """Lower-case words without ASCII punctuation around them."""
    out = []
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text or ""):
        core = re.sub(r"^[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+|[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+$", "", m[0])
        if core:
            out.append(re.sub("[A-Z]", lambda c: c[0].lower(), core))
    return out


def holds(words, part):
    return any(words[i : i + len(part)] == part for i in range(len(words) - len(part) + 1))


def test_every_exact_notice_is_found_and_nothing_else(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in op6_license_scan(spark, SF).collect()}
    assert rows.keys() == docs.keys()
    plain = {n: bare(t) for n, t in TEMPLATES.items()}
    some = 0
    for k, text in docs.items():
        words = bare(text)
        exact = {n for n, t in plain.items() if holds(words, t)}
        got = {s.rsplit(":", 2)[0] for s in rows[k]["spans"].split(",") if s}
        assert exact <= got
        if "licen" not in (text or "").lower():
            assert rows[k]["n_matches"] == 0 and rows[k]["licenses"] == "" and rows[k]["best_coverage"] == 0
        for span in filter(None, rows[k]["spans"].split(",")):
            name, a, b = span.rsplit(":", 2)
            if name in exact:
                assert bare(text[int(a) : int(b)]) == plain[name]
                some += 1
    assert some


def one(text, s=Settings()):
    return matches(pa.array([text], pa.string()), index_of(tuple(TEMPLATES.items()), s), s)[0]


def test_edited_grants_keep_their_coverage_and_span():
    words = TEMPLATES["MIT/grant"].split()
    del words[20:23]
    words[40] = "else"
    words.insert(10, "new")
    text = "é intro é " + " ".join(words) + " tail"
    (m,) = [m for m in one(text) if m["license"] == "MIT"]
    assert m["matched_words"] == len(TEMPLATES["MIT/grant"].split()) - 4 and m["coverage"] > 0.9
    assert text[m["start"] : m["end"]].split() == (" ".join(words)).rstrip(":").split()
    assert (m["first_word"], m["last_word"]) == (3, 2 + len(words))


def test_places_thresholds_and_odd_texts(spark):
    notice = TEMPLATES["Apache-2.0/notice"]
    twice = one(f"x {notice}\n{'filler ' * 30}\n{notice.upper()} y")
    assert [m["first_word"] for m in twice] == [1, 38] and all(m["coverage"] == 1 for m in twice)
    assert [m["coverage"] for m in one("Licensed under the MIT License")] == [0.8]
    assert one("the terms of the license") == [] and one(None) == [] and one("") == [] and one("*** !!!") == []
    assert one("word " * 20000 + TEMPLATES["MIT/notice"])[0]["first_word"] == 20000
    rows = [(1, notice), (1, notice), (None, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as license", "2 as matches")
    out = scan(df)
    assert out.columns[:4] == df.columns and sorted(len(r["lic__matches"]) for r in out.collect()) == [0, 0, 1, 1]
    assert scan(df.limit(0)).count() == 0


def test_winnowing_notices_every_long_enough_run():
    s = Settings()
    index = index_of(tuple(TEMPLATES.items()), s)
    need = s.gram + s.window - 1
    for t, text in enumerate(TEMPLATES.values()):
        _, _, word = bare_words(pa.array([text]))
        places = set(index.place[index.template == t].tolist())
        for a in range(len(word) - need + 1):
            assert places & set(range(a, a + s.window))


def test_alignment_against_a_full_table():
    import numpy as np

    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = rng.integers(0, 4, 8), rng.integers(0, 4, 12).tolist()
        table = np.zeros((9, 13))
        for i in range(8):
            for j in range(12):
                table[i + 1, j + 1] = max(0, table[i, j] + (2 if a[i] == b[j] else -1), table[i, j + 1] - 1, table[i + 1, j] - 1)
        n, first, end = align(a, b, 0, 20)
        assert n >= table.max() / 2 and 0 <= first < end <= 12 if table.max() else n == 0


def test_a_short_notice_is_found_with_any_one_word_changed_or_missing():
    for name, text in TEMPLATES.items():
        words = text.split()
        for i in range(len(words)) if len(words) < 30 else ():
            for new in (["other"], []):
                found = spans_at_threshold("a b c " + " ".join(words[:i] + new + words[i + 1 :]) + " d e f", name)
                tells = any(bare(words[i])[0] in some for some in DISTINCT.get(name, ((), ()))[0])
                assert found == ([] if tells else [(len(words) - 1) / len(words)]), (name, i, new)


def spans_at_threshold(text, name):
    index = index_of(((name, TEMPLATES[name]),), Settings())
    return [m["coverage"] for m in matches(pa.array([text]), index, Settings())[0]]


def test_copies_right_behind_each_other_are_all_found():
    for name, text in TEMPLATES.items():
        assert spans_at_threshold(" ".join([text] * 5), name) == [1.0] * 5
    assert [m["coverage"] for m in one("Released under an MIT License. " * 4)] == [0.8] * 4


def test_the_right_license_is_named_and_no_other():
    for name, text in TEMPLATES.items():
        assert {m["license"] for m in one(f"a b c {text} d e f")} == {name.partition("/")[0]}
    cc = "This work is licensed under a Creative Commons %s 4.0 International License."
    for text, want in (
        ("This work is licensed under the GNU General Public License, version 2.", set()),
        ("This work is licensed under the GNU General Public License, v3.", {"GPL-3.0"}),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", set()),
        (TEMPLATES["GPL/header"].replace("GNU General", "GNU Lesser General"), set()),
        (cc % "Attribution-NonCommercial", set()),
        (cc % "Attribution NonCommercial", set()),
        (cc % "Attribution-ShareAlike", {"CC-BY-SA-4.0"}),
        ("Released under the BSD License.", set()),
        ("Licensed under CC BY 4.0.", set()),
        ("Licensed under the Apache Licence, Version 2.0.", {"Apache-2.0"}),
    ):
        assert {m["license"] for m in one(text)} == want, text


def test_finds_of_different_licenses_compete():
    bank = {"A/x": "alpha beta gamma delta epsilon zeta", "B/x": "alpha beta gamma delta epsilon eta"}
    index = index_of(tuple(bank.items()), Settings())
    names = lambda text: [m["license"] for m in matches(pa.array([text]), index, Settings())[0]]
    assert names(bank["A/x"]) == ["A"] and names(bank["B/x"]) == ["B"]
    assert names(f"{bank['A/x']} and {bank['B/x']}") == ["A", "B"]


def test_long_templates_are_found_down_to_the_threshold():
    """As many words changed, or left out, as the threshold lets, evenly."""
    for name, text in TEMPLATES.items():
        words = text.split()
        least = math.ceil(0.75 * len(words))
        told = {w for some in DISTINCT.get(name, ((), ()))[0] for w in some}
        for offset in range(4) if len(words) >= 30 else ():
            places = [i for i in range(offset, len(words), 4) if not told.intersection(bare(words[i]))][: len(words) - least]
            for new in (["other"], []):
                edited = [x for i, w in enumerate(words) for x in (new if i in places else [w])]
                found = spans_at_threshold("a b c " + " ".join(edited) + " d e f", name)
                assert found and found[0] >= 0.75, (name, offset, new)


def test_tags_and_versions_are_named():
    for text, want in (
        ("// SPDX-License-Identifier: MIT", {"MIT"}),
        ("# spdx-license-identifier: GPL-2.0-or-later\n# Copyright", {"GPL-2.0-or-later"}),
        ("SPDX-License-Identifier: unheard-of", set()),
        ("MIT and Apache-2.0 and Zlib", set()),
        (TEMPLATES["GPL-2.0/header"], {"GPL-2.0"}),
        (TEMPLATES["AGPL-3.0/header"], {"AGPL-3.0"}),
        (TEMPLATES["LGPL-2.1/header"].replace("2.1", "3"), set()),
        ("Licensed under CC BY-SA 4.0.", {"CC-BY-SA-4.0"}),
    ):
        assert {m["license"] for m in one(text)} == want, text
