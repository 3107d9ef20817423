"""Licence scan against SQL, a plain TF-IDF, and hand-made trees; the plan stays in the JVM."""

from __future__ import annotations

import math
import re
from collections import Counter

import compare
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import licenses, oracles, queries

MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."


def scanned(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "path string, text string, license string, WORD int")
    return sorted((tuple(r) for r in licenses.scan(df, **kw).collect()), key=str)


def test_own_and_inherited_licences(spark):
    rows = [
        ("a/LICENSE", MIT), ("a/x.py", "code"), ("a/b/y.py", None), ("a/b/c/COPYING.txt", GPL), ("a/b/c/z.py", "# code\n"), ("a/b/c/d/e/w.py", ""),
        ("a/b/own.py", "code\n" + GPL + "\nmore"), ("q/x.py", "code"), ("aa/x.py", "code"), (None, "code"), ("root.py", GPL), ("a/x.py", "code"),
        ("a/license_of_mine.md", "nothing here"), ("b/notes.txt", MIT), ("b/x.py", "code"), ("a/long.py", "word " * 100_000),
    ]
    got = {(r[0], r[1], r[3], r[4]) for r in scanned(spark, rows)}
    assert got == {
        ("a/LICENSE", "MIT", "header", None), ("a/x.py", "MIT", "inherited", "a/"), ("a/b/y.py", "MIT", "inherited", "a/"),
        ("a/b/c/COPYING.txt", "GPL-3.0", "header", None), ("a/b/c/z.py", "GPL-3.0", "inherited", "a/b/c/"), ("a/b/c/d/e/w.py", "GPL-3.0", "inherited", "a/b/c/"),
        ("a/b/own.py", "GPL-3.0", "header", None), ("q/x.py", None, None, None), ("aa/x.py", None, None, None), (None, None, None, None),
        ("root.py", "GPL-3.0", "header", None), ("a/license_of_mine.md", "MIT", "inherited", "a/"), ("b/notes.txt", "MIT", "header", None),
        ("b/x.py", None, None, None), ("a/long.py", "MIT", "inherited", "a/"),
    }
    assert len(scanned(spark, rows)) == len(rows)


def test_licence_file_at_the_root_covers_all(spark):
    got = scanned(spark, [("LICENSE", MIT), ("x/y/z.py", "code"), ("z.py", "code")])
    assert [r[1] for r in got] == ["MIT"] * 3


def test_ties_go_to_the_first_path_and_name(spark):
    notices = spark.createDataFrame([("Z", "my licence words"), ("B", "my licence words")], "license string, notice string")
    got = scanned(spark, [("d/LICENSE.b", "my licence words"), ("d/LICENSE.a", "my licence words"), ("d/f", "x")], notices=notices)
    assert {r[1] for r in got} == {"B"}
    assert [r[4] for r in got if r[0] == "d/f"] == ["d/"]


def test_scores_equal_a_plain_version(spark):
    rows = [("a", MIT + " more words"), ("b", "the GNU general public License version 3"), ("c", "license"), ("d", "the of and")]
    words = lambda t: [w for w in re.split("[^a-z0-9]+", t.lower()) if w]
    vocabulary = {w for _, n in licenses.TEMPLATES for w in words(n)}
    df = Counter(w for _, t in rows for w in set(words(t)) & vocabulary)

    def vector(text):
        x = {w: n * (math.log((len(rows) + 1) / (df[w] + 1)) + 1) for w, n in Counter(words(text)).items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        return {w: v / norm for w, v in x.items()}

    for path, license, score, found, _ in scanned(spark, rows, least=0.3):
        text = dict(rows)[path]
        if not re.search(licenses.CUE, text.lower()):
            assert found is None
            continue
        best = max((sum(vector(text).get(w, 0) * v for w, v in vector(n).items() if w in vocabulary), name) for name, n in licenses.TEMPLATES)
        assert score == pytest.approx(best[0], abs=2e-6) if found else best[0] < 0.3


def test_no_rows(spark):
    assert scanned(spark, []) == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_query_equals_sql(spark, folder):
    df = queries.op2_license_scan(spark, folder)
    got = compare.spark_rows(df)
    assert got == compare.sql_rows(compare.connect(folder), oracles.OP2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(name in plan for name in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def made_files():
    """Tags, wrapped and marked notices, whole texts, several licences in one file, and files without any."""
    wrapped = "Copyright 2020 The Authors.\n\nThis work is\nlicensed under the GNU\nGeneral Public License,\nversion 3.\n"
    whole = dict(licenses.TEXTS)
    rows = [
        ("a/LICENSE", whole["BSD-3-Clause"].replace(". ", ".\n\n")), ("a/x.py", "code"), ("b/COPYING", whole["MIT"]), ("b/c/x.py", "code"),
        ("c/LICENSE.txt", "GNU GENERAL PUBLIC LICENSE\n  Version 2, June 1991\n\n" + "other words of it " * 200), ("c/x.py", "code"),
        ("d/tag.py", "# SPDX-License-Identifier: GPL-2.0-only\ncode"), ("d/tag.c", "/* SPDX-License-Identifier: MIT OR Apache-2.0 */"),
        ("d/tag2.c", "// spdx-license-identifier: lgpl-3.0-or-later\n// SPDX-License-Identifier: EPL-2.0"), ("d/LICENSE", "This work is licensed under the GNU General Public License, version 3."),
        ("e/wrapped.py", "\n".join("# " + line for line in wrapped.split("\n")) + "\nimport all_of_it"), ("e/rem.bat", "\n".join("REM " + line for line in wrapped.split("\n")) + "\n\necho on"),
        ("e/both.py", "All rights reserved.\nprint()\nReleased under the MIT License."), ("e/own.py", "Copyright Some Quite Long Name of Nowhere. All rights reserved."),
        ("e/three.md", "Licensed under the ISC License.\n\nReleased under the MIT License.\nLicensed under the BSD 2-Clause License."),
        ("f/NOTICE", "Licensed under the Apache License, Version 2.0."), ("f/unlicense.md", "nothing of the kind"), ("f/g/h/x.py", None), ("f/g/y.py", ""),
        ("g/licence-MIT", "the licence of this is not told"), ("g/x.py", "copyright nobody"), ("x.py", "no directory"),
        ("h/long.txt", "word " * 5000 + "\nthis text is Released under the MIT License. and more words stand beside it so that they differ " + "tail " * 300),
    ]
    return rows + [(f"z/{i % 7}/{i}", f"word{i} and all the rest, licence {i}") for i in range(60)]


def test_scan_equals_sql_on_made_files(spark):
    rows = made_files()
    con = compare.connect("/root/testdata/sf0.001")
    con.execute("CREATE TABLE made (path VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO made VALUES (?, ?)", rows)
    got = compare.spark_rows(licenses.scan(spark.createDataFrame(rows, "path string, text string")))
    want = compare.sql_rows(con, oracles.licences("SELECT path, text FROM made"))
    assert got == want
    found = {row[3]: (row[2], row[0]) for row in want[1]}  # path: license, found
    assert found["d/tag.py"] == ("GPL-2.0", "header") and found["d/tag.c"] == ("MIT OR Apache-2.0", "header")
    assert found["e/wrapped.py"] == found["e/rem.bat"] == ("GPL-3.0", "header") and found["e/both.py"] == ("MIT", "header")
    assert found["c/x.py"] == ("GPL-2.0", "inherited") and found["h/long.txt"] == ("MIT", "header")


def test_cues_are_the_same_both_ways(spark):
    texts = ["LICENSE", "Licence", "licenc", "CopyRight", "SPDX", "public  domain", "Public Domain", "all rights reserved", "all rights", "", None, "Creative Commons", "permission is hereby granted"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(F.coalesce(licenses._cued(F.col("text")), F.lit(False)), F.coalesce(F.lower("text").rlike(licenses.CUE), F.lit(False)))
    assert all(a == b for a, b in rows.collect())


def test_a_text_is_split_once(spark):
    df = licenses.scan(spark.createDataFrame([("a", "x")], "path string, text string"))
    assert df.count() == 1
    split = spark.createDataFrame([("a", "license")], "path string, text string")
    plan = split.where(licenses._cued(F.col("text")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1


def test_every_planted_licence_line_is_found(spark):
    folder = "/root/testdata/sf0.1"
    found = queries.op2_license_scan(spark, folder).where("found = 'header'").count()
    docs = queries.table(spark, folder, "documents").where(F.lower("text").rlike(licenses.CUE))
    assert found == docs.count() > 300


def test_short_forms_score_alike_among_many_files(spark):
    rows = [
        ("p/own.txt", "All rights reserved."), ("p/LICENSE", MIT), ("t/a.py", "# SPDX-License-Identifier: MIT\ncode"), ("t/b.c", "/* SPDX-License-Identifier: gpl-3.0-or-later */"),
        ("t/c.rs", "// SPDX-License-Identifier: MIT OR Apache-2.0"), ("t/d.py", "# SPDX-License-Identifier: EPL-2.0"),
        ("t/e.py", "Copyright 2021 Some Quite Long Company Name of Nowhere. All rights reserved."), ("t/f.py", "All rights reserved.\n" + GPL),
    ]
    for more in (0, 3000):
        got = {r[0]: r[1:3] for r in scanned(spark, rows + [(f"z/{i}", f"word{i} all the rest") for i in range(more)])}
        assert got["p/own.txt"] == ("Proprietary", 1.0) and got["p/LICENSE"] == ("MIT", 1.0)
        assert [got[f"t/{x}"] for x in ("a.py", "b.c", "c.rs", "d.py", "e.py")] == [("MIT", 1.0), ("GPL-3.0", 1.0), ("MIT OR Apache-2.0", 1.0), ("EPL-2.0", 1.0), ("Proprietary", 1.0)]
        assert got["t/f.py"] == ("GPL-3.0", 1.0)


def test_wrapped_notices_and_whole_licence_texts(spark):
    as_is = licenses._AS_IS.replace(". ", ".\n").replace(", ", ",\n")
    bsd = (
        "Copyright (c) 2019, Jane Doe of Somewhere\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n"
        "1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice,\n"
        "   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n\n{}" + as_is
    )
    third = "3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.\n\n"
    mit = dict(licenses.TEXTS)["MIT"].replace("(c)", "(c) 2020 Jane Doe\n\n").replace(", ", ",\n").replace("THE SOFTWARE IS", "\n\nTHE SOFTWARE IS")
    marked = lambda text, mark: "\n".join(mark + line for line in text.split("\n"))
    wrapped = "Copyright 2020 The Authors of Things.\n\nThis work is\nlicensed under the GNU\nGeneral Public License,\nversion 3.\n"
    rows = [
        ("a/LICENSE", bsd.format(third)), ("a/x.py", "code"), ("b/LICENSE", mit), ("b/x.py", "code"), ("c/LICENSE.txt", bsd.format("")), ("c/x.py", "code"),
        ("d/COPYING", "   GNU GENERAL PUBLIC LICENSE\n      Version 2, June 1991\n\n" + "every other word of it " * 400), ("d/x.py", "code"),
        ("e/wrapped.py", marked(wrapped, "# ") + "\nimport all_of_it\n"), ("e/header.c", "/*\n" + marked(bsd.format(third), " * ") + "\n */\n\nint main;\n"),
        ("e/rem.bat", marked(wrapped, "REM ") + "\n\necho on"), ("e/plain.txt", "some prose\n\n" + wrapped + "\nmore prose"),
    ]
    for more in (0, 3000):
        got = {r[0]: r[1] for r in scanned(spark, rows + [(f"z/{i}", f"word{i} of all the rest") for i in range(more)])}
        assert {p: got[p] for p, _ in rows} == {
            "a/LICENSE": "BSD-3-Clause", "a/x.py": "BSD-3-Clause", "b/LICENSE": "MIT", "b/x.py": "MIT", "c/LICENSE.txt": "BSD-2-Clause", "c/x.py": "BSD-2-Clause",
            "d/COPYING": "GPL-2.0", "d/x.py": "GPL-2.0", "e/wrapped.py": "GPL-3.0", "e/header.c": "BSD-3-Clause", "e/rem.bat": "GPL-3.0", "e/plain.txt": "GPL-3.0",
        }
