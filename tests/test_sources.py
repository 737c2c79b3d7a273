"""Dumps whose statements span lines, and pages behind a callable."""

from __future__ import annotations

import os

import pytest
from lectern.sources.dumps import dump_tables, read_dump, statements
from lectern.sources.paged import Busy, read_pages

DUMP = r"""-- a dump
/*!40101 SET NAMES utf8 */;
CREATE TABLE IF NOT EXISTS `words` (
  `id` int(11) NOT NULL AUTO_INCREMENT,
  `root` varchar(20) DEFAULT NULL,
  word text,
  `share` decimal(10,2),
  PRIMARY KEY (`id`),
  KEY `by_root` (`root`, word)
) ENGINE=InnoDB;
INSERT INTO `words` VALUES
(1, 'ktb', 'it''s, (so)', 1.50),
(2, NULL, 'line one;
line two', -2),
(3, 'a;
INSERT INTO `words` VALUES (9,9,9,9);
', "double \"quoted\" 'x'", NULL);
INSERT INTO words (word, id) VALUES ('back\\slash\ttab\'', 4), ('', 5);
insert into `other` values (7);
INSERT INTO `words` VALUES (6,'end','last',0);
"""


def test_dumps_of_statements_over_lines(spark, tmp_path):
    path = str(tmp_path / "dump.sql")
    with open(path, "w") as f:
        f.write(DUMP)
    found = statements(spark, path)
    assert found.count() == 6
    assert dump_tables(found) == {"words": [("id", "long"), ("root", "string"), ("word", "string"), ("share", "double")]}
    rows = sorted(map(tuple, read_dump(spark, path, "words").collect()))
    assert rows == [
        (1, "ktb", "it's, (so)", 1.5),
        (2, None, "line one;\nline two", -2.0),
        (3, "a;\nINSERT INTO `words` VALUES (9,9,9,9);\n", "double \"quoted\" 'x'", None),
        (4, None, "back\\slash\ttab'", None),
        (5, None, "", None),
        (6, "end", "last", 0.0),
    ]
    assert [r[0] for r in read_dump(spark, path, "other", [("n", "long")]).collect()] == [7]
    with pytest.raises(ValueError):
        read_dump(spark, path, "other")


def test_a_large_dump_is_read_in_parts(spark, tmp_path):
    path = str(tmp_path / "dump.sql")
    with open(path, "w") as f:
        f.write("CREATE TABLE t (id bigint, x text);\n")
        for i in range(3000):
            f.write(f"INSERT INTO t VALUES ({i},'{'y' * 300};\n{i}'),\n({i + 10_000},'z');\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        found = read_dump(spark, path, "t")
        assert found.count() == 6000 and found.filter("x = 'z'").count() == 3000
        assert {r["x"][-4:] for r in found.filter("id = 77").collect()} == {";\n77"}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_long_strings_do_not_exhaust_the_stack(spark, tmp_path):
    path = str(tmp_path / "dump.sql")
    with open(path, "w") as f:
        f.write("CREATE TABLE t (id int, x longtext);\nINSERT INTO t VALUES (1,'" + "word \\' '' " * 50_000 + "');\n")
    assert len(read_dump(spark, path, "t").first()["x"]) == len("word ' ' ") * 50_000


def test_pages_are_read_with_retries(spark, tmp_path):
    marks = str(tmp_path)

    def fetch(page):
        seen = os.path.join(marks, str(page))
        if page % 3 == 0 and not os.path.exists(seen):
            open(seen, "w").close()
            raise Busy if page else TimeoutError
        return [(page, f"row {i}") for i in range(page % 4)]

    found = read_pages(spark, fetch, "page int, text string", 20, parts=6, wait=0.01)
    assert sorted(map(tuple, found.collect())) == [(p, f"row {i}") for p in range(20) for i in range(p % 4)]
    assert len(os.listdir(marks)) == 7 and read_pages(spark, fetch, "page int, text string", 0).count() == 0

    def broken(page):
        raise Busy

    with pytest.raises(Exception, match="Busy"):
        read_pages(spark, broken, "page int", 1, attempts=2, wait=0.01).collect()
