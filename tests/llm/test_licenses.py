import pytest

from rosterlake.llm.licenses import TEMPLATES, scan_licenses

APACHE = "Licensed under the Apache License, Version 2.0."
GPL = "This work is licensed under the GNU General Public License, version 3."


@pytest.fixture
def files(spark):
    rows = [
        (1, "a/LICENSE", GPL),
        (2, "a/x.py", "code\ncode"),
        (3, "a/b/c/y.py", "code"),
        (4, "a/b/c/z.py", f"# {APACHE}\ncode " + "more words " * 500),
        (5, "other/w.py", "the license of other things is not stated here at all"),
        (6, "top.py", None),
        (None, "a/b/null.py", ""),
        (7, None, "MIT"),
        (8, "a/d/LICENSE", APACHE),
        (9, "a/d/COPYING", APACHE),
        (10, "a/d/e/f.py", "x"),
        (11, "ab/g.py", "a directory whose name begins alike"),
        (2, "a/x.py", "code\ncode"),
        (12, "long/h.py", "word " * 100_000 + "\n" + "RELEASED UNDER THE MIT LICENSE."),
    ]
    return spark.createDataFrame([(*r, 0, "t") for r in rows], "id bigint, path string, text string, license int, term string")


def test_headers_and_inheritance(files):
    found = sorted(((r.id, r.path, r.license, r.source) for r in scan_licenses(files, "id", "path", "text").collect()), key=str)
    expected = [
        (1, "a/LICENSE", "GPL-3.0", "header"),
        (2, "a/x.py", "GPL-3.0", "directory"),
        (2, "a/x.py", "GPL-3.0", "directory"),
        (3, "a/b/c/y.py", "GPL-3.0", "directory"),
        (4, "a/b/c/z.py", "Apache-2.0", "header"),
        (5, "other/w.py", None, "none"),
        (6, "top.py", None, "none"),
        (None, "a/b/null.py", "GPL-3.0", "directory"),
        (7, "", None, "none"),
        (8, "a/d/LICENSE", "Apache-2.0", "header"),
        (9, "a/d/COPYING", "Apache-2.0", "header"),
        (10, "a/d/e/f.py", "Apache-2.0", "directory"),
        (11, "ab/g.py", None, "none"),
        (12, "long/h.py", "MIT", "header"),
    ]
    assert found == sorted(expected, key=str)


def test_every_template_finds_itself(spark):
    rows = [(i, f"d{i}/f", text) for i, (_, text) in enumerate(TEMPLATES)]
    found = {r.id: (r.license, r.score) for r in scan_licenses(spark.createDataFrame(rows, "id int, path string, text string"), "id", "path", "text").collect()}
    assert found == {i: (name, 1.0) for i, (name, _) in enumerate(TEMPLATES)}


def test_tags_are_told_apart(spark):
    """SPDX tags behind any comment sign, several identifiers in one table, unknown ones."""
    tags = ["MIT", "Apache-2.0", "GPL-3.0", "GPL-2.0", "BSD-3-Clause", "Unknown-1.0"] * 3
    rows = [(i, f"d{i}/f", f"{sign} SPDX-License-Identifier: {tag}\ncode of {i}") for i, (tag, sign) in enumerate(zip(tags, "#/;%*-" * 3))]
    found = {r.id: r.license for r in scan_licenses(spark.createDataFrame(rows, "id int, path string, text string"), "id", "path", "text").collect()}
    assert found == {i: None if tag.startswith("Unknown") else tag for i, tag in enumerate(tags)}


def test_empty_table(files):
    assert scan_licenses(files.limit(0), "id", "path", "text").count() == 0
    assert {r.source for r in scan_licenses(files.filter("id in (2, 6)"), "id", "path", "text").collect()} == {"none"}


def test_no_python_in_the_plan(files):
    plan = scan_licenses(files, "id", "path", "text")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
