import re
from collections import Counter

from quillmill.llm import license_scan, queries

from .conftest import SF


def by_hand(text, templates=license_scan.TEMPLATES, threshold=license_scan.THRESHOLD):
    """Licenses of a text by trying every window as long as two of the template's classes."""
    words, found = re.findall(r"[^\W_]+", (text or "").lower()), set()
    for name, notice in templates:
        want = re.findall(r"[^\W_]+", notice.lower())
        size = min(5, len(want))
        have = {tuple(want[i : i + size]) for i in range(len(want) - size + 1)}
        c = max(2, 1 << (len(have) - 1).bit_length())
        run = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
        hits = [(i, s) for i, s in enumerate(run) if s in have]
        if any(len({s for j, s in hits if i <= j < i + c}) >= threshold * len(have) for i, _ in hits):
            found.add(name)
    return found


def test_query_against_every_window(spark, documents):
    got, rows = queries.QUERIES["op6_license_scan"](spark, SF).collect(), documents.collect()
    texts = [r.text or "" for r in rows]
    templates = license_scan.Templates(license_scan.TEMPLATES, license_scan.THRESHOLD)
    matches = license_scan.text_matches(templates, texts)
    want = {(r.doc_id, name) for r in rows for name in by_hand(r.text)}
    assert {(r.doc_id, templates.names[m[2]]) for r, found in zip(rows, matches) for m in found} == want and want
    spans = {}
    for r in got:
        spans.setdefault(r.doc_id, []).append((r.start_char, r.end_char, r.license))
    for r in rows:  # what is not reported overlaps with what is; reported spans do not overlap
        own = sorted(spans.get(r.doc_id, []))
        assert all(x[1] <= y[0] for x, y in zip(own, own[1:]))
        assert all(name in by_hand(r.text[x:y]) for x, y, name in own)
        assert bool(own) == bool(by_hand(r.text))


def found_in(spark, *texts):
    rows = license_scan.license_notices(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    return [[r.license for r in sorted(rows, key=lambda r: r.start_char) if r.doc_id == i] for i in range(len(texts))]


GNU = "This {0} is free software{2} you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation"
LATER = "; either version {0} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful."


def test_versions_and_families_are_told_apart(spark):
    gnu = {
        "GPL-2.0-or-later": ("program", "General Public License", "2"),
        "GPL-3.0-or-later": ("program", "General Public License", "3"),
        "LGPL-2.0-or-later": ("library", "Library General Public License", "2"),
        "LGPL-2.1-or-later": ("library", "Lesser General Public License", "2.1"),
        "LGPL-3.0-or-later": ("library", "Lesser General Public License", "3"),
        "AGPL-3.0-or-later": ("program", "Affero General Public License", "3"),
    }
    texts = [GNU.format(what, name, ":") + LATER.format(v) for what, name, v in gnu.values()]
    assert found_in(spark, *texts) == [[name] for name in gnu]
    only = GNU.format("program", "General Public License", ";") + "; version 2 of the License."
    assert found_in(spark, only) == [["GPL-2.0-only"]]


def test_clauses_of_bsd_and_kinds_of_creative_commons(spark):
    two, three = [dict(license_scan.TEMPLATES)[f"BSD-{n}-Clause"] for n in (2, 3)]
    ours = three.replace("the copyright holder nor the names of its", "Example Inc. nor the names of their").replace("COPYRIGHT HOLDERS", "AUTHORS")
    share = "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    assert found_in(spark, two, three, ours, "Copyright 2020 X.\n" + two.replace("COPYRIGHT HOLDERS", "AUTHORS")) == [["BSD-2-Clause"], ["BSD-3-Clause"], ["BSD-3-Clause"], ["BSD-2-Clause"]]
    assert found_in(spark, share, share.replace("-ShareAlike", ""), share.replace("4.0 International", "3.0 Unported")) == [["CC-BY-SA-4.0"], ["CC-BY-4.0"], ["CC-BY-SA-3.0"]]


def test_every_span_of_a_text(spark):
    permission = license_scan.TEMPLATES[1][1]
    cut = " ".join(permission.split()[2:])  # the second one lacks its beginning
    filler = " lorem ipsum dolor sit amet" * 300
    texts = [permission + " " + permission, permission + " " + cut + " " + permission, permission + filler + cut + filler + " All rights reserved." + filler + permission]
    assert found_in(spark, *texts) == [["MIT"] * 2, ["MIT"] * 3, ["MIT", "MIT", "all-rights-reserved", "MIT"]]


def test_templates_from_files(spark, tmp_path):
    (tmp_path / "House-1.0~short.txt").write_text("You may copy this house document as often as you like")
    (tmp_path / "House-1.0.txt").write_text("You may copy this house document as often as you like, if you also water the plants every second day")
    templates = license_scan.read_templates(str(tmp_path))
    assert [name for name, _ in templates] == ["House-1.0"] * 2
    docs = spark.createDataFrame([(1, templates[0][1].upper()), (2, "else")], "doc_id bigint, text string")
    assert [(r.doc_id, r.license, r.containment) for r in license_scan.license_notices(docs, templates).collect()] == [(1, "House-1.0", 1.0)]


def test_planted_notices(spark):
    filler = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor " * 40
    rows, want = [], set()
    for i, (name, notice) in enumerate(license_scan.TEMPLATES):
        for k, text in enumerate((notice, filler + notice.upper() + filler, f"# {notice.replace(' ', chr(10) + '*  ')} {filler}", filler[: 37 * i] + " " + notice)):
            rows.append((10 * i + k, text))
            want.add((10 * i + k, name))
    got = license_scan.license_notices(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.doc_id, r.license) for r in got} >= want
    texts = dict(rows)
    assert all(name_in(texts[r.doc_id][r.start_char : r.end_char], r.license) for r in got)


def name_in(span, license):
    return license in by_hand(span)


def test_part_of_a_notice(spark):
    notice = license_scan.TEMPLATES[1][1].split()
    rows = [(0, " ".join(notice[:-3])), (1, " ".join(notice[:12])), (2, " ".join(notice[:-2] + ["x"] * 5))]
    got = {r.doc_id: r.containment for r in license_scan.license_notices(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert sorted(got) == [0, 2] and all(0.8 <= v < 1 for v in got.values())


def test_odd_rows(odd, empty):
    assert license_scan.license_notices(odd).count() == 0 and license_scan.license_notices(empty).count() == 0
    spark = odd.sparkSession
    twice = spark.createDataFrame([(None, "All rights reserved."), (1, "all RIGHTS reserved"), (1, "all RIGHTS reserved")], "doc_id bigint, text string")
    assert Counter((r.doc_id, r.start_char, r.end_char) for r in license_scan.license_notices(twice).collect()) == {(None, 0, 19): 1, (1, 0, 19): 2}
