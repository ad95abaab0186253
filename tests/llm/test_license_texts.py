"""Whole texts of the long licences, and forms of one text that must agree."""

from pathlib import Path

import pytest

from rillstone.llm.license_scan import license_scan
from rillstone.llm.license_texts import NAMES, TEXTS

WITHOUT_TEXT = {"AGPL-3.0-only", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0"}


def test_which_names_have_a_whole_text():
    assert set(NAMES) - {i for i, t in TEXTS if i != "Apache-2.0" or len(t) > 5000} == WITHOUT_TEXT


def test_shipped_texts_are_found(spark):
    shipped = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only", "LGPL-2.1": "LGPL-2.1-only", "LGPL-3": "LGPL-3.0-only", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    paths = {i: Path("/usr/share/common-licenses", f) for f, i in shipped.items()}
    if not all(p.exists() for p in paths.values()):
        pytest.skip("no licence texts on this machine")
    rows = [(i, p.read_text(encoding="utf-8").replace("\n", "\r\n")) for i, p in paths.items()]
    got = license_scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {(r.doc_id, r.license_id) for r in got} == {(i, i) for i in paths}


CREDITS = ["# Copyright (c) 2020 A", "// Copyright 2020 A", " * Copyright (c) A", "Copyright The A Authors", "Copyright, 2020 A", "Copyright [yyyy] [name of copyright owner]", "/* (c) 2020 A */", "(C) Some One", ".. Copyright by A", "Copyright A, Inc.", "Portions Copyright © A", "All rights reserved."]
TERMS = ["copyright notice and this permission notice shall be", "COPYRIGHT OWNER OR CONTRIBUTORS BE", "COPYRIGHT HOLDERS AND CONTRIBUTORS", "copyright the work", "(c) You must retain, in the Source form", "copyright license to reproduce"]


def test_credits_go_and_terms_stay(spark):
    mit = dict(TEXTS)["Zlib"]
    rows = [(c, f"{c}\n\n{mit}") for c in CREDITS + TERMS]
    found = {r.doc_id: r.license_id for r in license_scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert found == {c: "Zlib" for c in CREDITS} | {c: None for c in TERMS}


def test_broken_lines_and_comment_marks_agree(spark):
    bsd = next(t for i, t in TEXTS if i == "BSD-3-Clause").replace("COPYRIGHT HOLDER OR CONTRIBUTORS", "COPYRIGHT OWNER OR CONTRIBUTORS")
    apache = max((t for i, t in TEXTS if i == "Apache-2.0"), key=len)
    forms = [bsd, bsd.replace("COPYRIGHT OWNER", "COPYRIGHT\nOWNER"), "# Copyright (c) 2020 A\n" + "\n".join(f"# {x}" for x in bsd.replace(" ", "\n").split("\n"))]
    rows = [("BSD-3-Clause", t) for t in forms] + [("Apache-2.0", apache.replace("(c) You must retain, in the Source form", "(c) You must retain, in the\n Source form")), ("Apache-2.0", apache.replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2020 A"))]
    rows += [("made", "we fulfil\nit"), ("made", "we fulfill it"), ("made", "we\nfulfil it")]
    got = license_scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert all(r.license_id == (None if r.doc_id == "made" else r.doc_id) for r in got)
    assert len({(r.doc_id, r.digest) for r in got}) == 3
