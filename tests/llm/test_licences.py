from tidemark.llm import licences


def test_held_out_paragraphs():
    own = licences.trained()
    data = licences.made(seed=1234, each=30)
    right = missed = wrong = 0
    for words, family in data:
        got = licences.found(b" ".join(words), own, 0.6, 0.75)
        right += set(got) == (set() if family == licences.UNKNOWN else {family})
        missed += family != licences.UNKNOWN and not got
        wrong += bool(got) and family not in got
    assert right / len(data) > 0.9
    assert wrong / len(data) < 0.03


def test_calibration():
    """Of what gets a probability of p, about p is right."""
    own = licences.trained()
    got = [(own.probabilities(w), f) for w, f in licences.made(seed=99, each=30)]
    top = [(p.max(), own.families[int(p.argmax())] == f) for p, f in got]
    assert abs(sum(p for p, _ in top) / len(top) - sum(r for _, r in top) / len(top)) < 0.08


def test_words_between_template_words():
    own = licences.trained()
    words = licences.words_of
    assert licences.aligned(words(b"All rights reserved."), words(b"Please note: all rights of way are reserved.")) < 0.75
    assert licences.aligned(words(b"Released under the MIT License."), words(b"Released under the terms of the MIT License.")) > 0.75
    assert licences.found(b"Please note: all rights of way are reserved.", own, 0.6, 0.75) == {}
    assert set(licences.found(b"Copyright 2020 by nobody. All rights reserved.", own, 0.6, 0.75)) == {"proprietary"}


LINES = {
    "Released under the MIT License.": "mit", "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0", "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0", "All rights reserved.": "proprietary",
}


def test_query_on_documents(spark):
    from tidemark.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect()
    want = {(r["doc_id"], f) for r in docs for line, f in LINES.items() if line in r["text"]}
    got = {(r["doc_id"], r["family"]) for r in QUERIES["op7_licences"](spark, "/root/testdata/sf0.1").collect()}
    assert want and got == want


def test_odd_rows(spark):
    long = "word of the " * 60_000 + "\n" + "Released under the MIT License.\n" + "the general public " * 60_000
    many = "\n".join([*LINES] * 50)
    rows = [(1, None), (2, ""), (3, "\n \n"), (4, long), (4, long), (None, many), (5, "A licence plate. All of it."), (6, "x " * 500 + "Licensed under CC BY-NC 4.0." + " y" * 500)]
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], "doc_id long, text string, TEXT string, family string")
    got = licences.report(df, sample_docs=5).collect()
    assert sorted((r["doc_id"] or 0, r["family"], r["n_paragraphs"]) for r in got) == sorted([(0, f, 50) for f in LINES.values()] + [(4, "mit", 1)] * 2 + [(6, "cc-by-nc-4.0", 1)])
    assert licences.report(df.limit(0)).count() == 0
    out = licences.families(df)
    assert out.columns == [*df.columns, "licences"] and out.count() == len(rows)


GPL2 = """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version."""
CASES = [
    (GPL2, {"gpl-2.0"}),
    (GPL2.replace("version 2", "version 3"), {"gpl-3.0"}),
    (GPL2.replace("General", "Affero General").replace("version 2", "version 3"), {"agpl-3.0"}),
    (GPL2.replace("program", "library").replace("General", "Lesser General").replace("version 2", "version 2.1"), {"lgpl"}),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.", {"isc"}),
    ("Licensed under the Apache License, Version 1.1.", set()),
    ("He drove without a license under the Apache helicopter, version 2.0 of the plan.", set()),
    ("Please note: all rights of way are reserved.", set()),
    ('Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.', {"apache-2.0"}),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", {"cc-by-sa-4.0"}),
    ("The committee met under the terms of an agreement with the public library.", set()),
]


def test_headers_wrapped_and_on_one_line():
    own = licences.trained()
    for text, want in CASES:
        for t in (text, text.replace("\n", " "), "\n".join("# " + x for x in text.split("\n")), "\n".join(" * " + x for x in text.split("\n")), "A word before this. " + text + " " + "and so it went on " * 30):
            assert set(licences.found(t.encode(), own, 0.6, 0.75)) == want, t


def test_stretches_stay_linear():
    """A stretch of any length gives each of its licences, and nothing is judged beyond its end."""
    own = licences.trained()
    text = " ".join(["Released under the MIT License and licensed under the Mozilla Public License, version 2.0, as told"] * 200)
    assert {"mit", "mpl-2.0"} <= set(licences.found(text.encode(), own, 0.6, 0.75))
    assert list(licences.paragraphs(b"a b\nc.\n\n# \nd\n\ne")) == [([b"a", b"b", b"c"], [0, 2]), ([b"d"], [0]), ([b"e"], [0])]
