"""Whole texts of common licences, and copyright lines without a year or behind comment marks."""

from __future__ import annotations

from pathlib import Path

import pytest

from quire.llm import licenses

TEXTS = Path("/usr/share/common-licenses")


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text_license"] for r in licenses.scan(docs).orderBy("doc_id").collect()]


@pytest.mark.skipif(not TEXTS.exists(), reason="no licence texts on this system")
def test_whole_texts_of_common_licenses(spark):
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "BSD": "BSD-3-Clause"}
    texts = [(TEXTS / f).read_text() for f in names]
    assert found(spark, texts) == list(names.values())
    assert found(spark, ["\n".join("# " + x for x in t.split("\n")) for t in texts]) == list(names.values())
    assert found(spark, [texts[0].split("END OF TERMS")[0], texts[0] + " more"]) == ["Apache-2.0", None]


@pytest.mark.parametrize("line", ["Copyright (c) Jane Doe", "Copyright (c) <year> <holder>", "# Copyright 2020 X", "// Copyright 2020 X", " * Copyright (C) Jane Doe", "Copyright [yyyy] [name]", "© Jane Doe", "Copyright 2020 X"])
def test_copyright_lines(spark, line):
    assert found(spark, [f"{line}\n\n{licenses.MIT}", f"{line}\n# All rights reserved.\n\n{licenses.BSD3}"]) == ["MIT", "BSD-3-Clause"]


def test_wrapped_lines_of_a_license_stay(spark):
    wrapped = licenses.MIT.replace("The above copyright", "The above\ncopyright").replace("OR COPYRIGHT", "OR\nCOPYRIGHT")
    assert found(spark, [wrapped]) == ["MIT"]


def test_rows_have_their_own_notices(spark):
    rows = [(None, "Licensed under the MIT License."), (None, "nothing here"), (3, "Licensed under the MIT License.\nother"), (3, "plain"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    own = licenses.known_licenses(spark)
    for known in (None, own):
        got = sorted((str(r["doc_id"]), r["notice_licenses"], r["n_notices"]) for r in licenses.scan(docs, known).collect())
        assert got == [("3", [], 0), ("3", ["MIT"], 1), ("4", [], 0), ("None", [], 0), ("None", ["MIT"], 1)]
