"""Licence notices that are wrapped over lines, or have none of the usual stems."""

from risewatch.llm import licences


def test_wrapped_and_short_notices(spark, docs):
    model = licences.LicenceModel(spark, docs)
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files, to deal\nin the Software without restriction"
    texts = [bsd, f"first line\n\nanother line here\n{mit}\n\nthe end", "Distributed under BSD-3-Clause."]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [tuple(r) for r in model.scan(frame).select("doc_id", "paragraph", "family", "confirmed").collect()]
    assert {r for r in rows if r[3]} == {(0, 0, "BSD", True), (1, 3, "MIT", True), (2, 0, "BSD", True)}
    assert (2, 0, "BSD") in {r[:3] for r in rows}
