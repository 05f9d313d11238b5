"""The filter of the licence scan loses nothing, and short notices are known."""

import pytest

from risewatch.llm import licences


@pytest.fixture(scope="module")
def model(spark, docs):
    return licences.LicenceModel(spark, docs)


def test_filtered_scan_equals_the_plain_one(spark, docs, model):
    assert model.needed and not set(model.needed) & {"the", "of", "and", "to", "are"}
    plain, quick = (sorted(map(str, model.scan(docs, filtered=x).collect())) for x in (False, True))
    assert plain == quick and plain


def test_short_notices(spark, model):
    texts = {
        "Released under MIT.": "MIT",
        "SPDX-License-Identifier: MIT": "MIT",
        "GPLv3": "GPL",
        "Apache License 2.0": "Apache-2.0",
        "some text\nSPDX-License-Identifier: GPL-2.0-only\nmore": "GPL",
        "The work is available under CC BY-NC 4.0": "CC-BY-NC",
        "Students at MIT released a new study on public transport.": None,
        "Under the terms of the agreement the work is done by June.": None,
    }
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["family"], r["confirmed"]) for r in model.scan(frame).where("family <> 'unknown'").collect()}
    assert {i: got[i][0] if i in got else None for i in range(len(texts))} == dict(enumerate(texts.values()))
    assert all(confirmed for _, confirmed in got.values())


def test_wordings_of_training_and_of_calibration_differ(model):
    held = {t for _, t, out in licences._texts() if out}
    assert held.isdisjoint(t for _, t, out in licences._texts() if not out) and model.accuracy >= 0.95
