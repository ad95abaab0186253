"""Canonical forms that must and must not agree."""

from rillstone.llm.license_scan import license_scan
from rillstone.llm.license_texts import MIT, TEXTS


def test_texts_and_notices(spark):
    wrapped = "Copyright (c) 2021 Someone\n\n" + MIT.replace(", ", ",\n  ").upper().replace('"', "“") + "\nAll rights reserved.\n"
    rows = [
        (1, MIT), (2, wrapped), (3, MIT.replace("sublicense", "sublicence")), (4, MIT.replace("free of charge", "for a fee")), (5, "Some words.\nReleased under the MIT License."),
        (6, "released UNDER the mit licence!\r\n (c) me\nLicensed under CC BY-NC 4.0.\nlicensed under cc-by-nc-4.0"), (7, None), (8, ""), (9, "x " * 40_000), (5, "Some words.\nReleased under the MIT License."), (5, "other"), (None, MIT),
    ]
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, digest string")
    got = license_scan(docs).collect()
    found = {(r.doc_id, r.license_id, r.n_notices, r.notice_licenses) for r in got}
    assert len(got) == len(rows)
    assert found == {(1, "MIT", 0, ""), (2, "MIT", 0, ""), (3, "MIT", 0, ""), (4, None, 0, ""), (5, None, 1, "MIT"), (6, None, 3, "CC-BY-NC-4.0,MIT"), (7, None, 0, ""), (8, None, 0, ""), (9, None, 0, ""), (5, None, 0, ""), (None, "MIT", 0, "")}
    assert license_scan(docs.limit(0)).count() == 0
    assert len({r.digest for r in got if r.doc_id in (1, 2, 3)}) == 1


def test_every_known_text_finds_itself(spark):
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(TEXTS)], "doc_id long, text string")
    assert {(r.doc_id, r.license_id) for r in license_scan(docs).collect()} == {(k, i) for k, (i, _) in enumerate(TEXTS)}
