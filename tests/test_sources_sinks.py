from __future__ import annotations

import pytest
from conftest import executed_plans, last_execution, rows

from palate.__main__ import main
from palate.operators.staging import clear_staged, stage_measured, staging_path, staging_root
from palate.sinks import write_csv
from palate.sources import SCHEMAS, read_csv, read_csv_checked, read_csv_tables, read_parquet_tables, read_result

AWKWARD = {
    "movies": [
        ("1", 'Movie, The "Best" (1999)', "a|b"),
        ("2", " spaced ", "(no genres listed)"),
        ("3", None, ""),
        ("4", '"', "x"),
        ("5", "back\\slash \\\"", "y|z"),
    ],
    "ratings": [("1", "2", 4.5), ("1", "3", None), ("02", "2", 0.5)],
    "tags": [
        ("1", "2", 'a "quoted", tag'),
        ("1", "2", None),
        ("1", "2", ""),
        ("1", "2", "  x "),
        ("1", "2", ",,"),
        ("1", "2", "éü漢"),
        ("1", "2", "#no comment"),
    ],
    "genome_scores": [("1", "2", 0.025), ("1", "3", 1.0)],
    "genome_tags": [("1", "007, (series)"), ("2", 'say "hi"')],
}


@pytest.mark.parametrize("table", sorted(SCHEMAS))
def test_csv_roundtrip(spark, tmp_path, table):
    df = spark.createDataFrame(AWKWARD[table], SCHEMAS[table])
    write_csv(df, str(tmp_path / "t"))
    back = read_csv(spark, table, str(tmp_path / "t"))
    assert back.schema == SCHEMAS[table]
    assert rows(back) == rows(df)


@pytest.mark.parametrize("text", ["a\nb", "x\ry"])
def test_line_breaks_are_rejected(spark, tmp_path, text):
    df = spark.createDataFrame([("1", "2", text)], SCHEMAS["tags"])
    with pytest.raises(Exception, match="line break in column tag"):
        write_csv(df, str(tmp_path / "t"))


BREAKS = ["a\nb", "x\ry", "\r\n", "\\", "\\n", "\\\\n", "a\\\nb", "tail\\", "\n\\", "", None, "plain", 'a "q",\nb', " \n "]


def test_line_breaks_come_back(spark, tmp_path):
    df = spark.createDataFrame([("1", str(i), text) for i, text in enumerate(BREAKS)], SCHEMAS["tags"])
    write_csv(df, str(tmp_path / "t"), line_breaks="escape")
    assert rows(read_csv(spark, "tags", str(tmp_path / "t"), escaped=True)) == rows(df)
    assert rows(read_result(spark, "user_id string, movie_id string, tag string", str(tmp_path / "t"), escaped=True)) == rows(df)
    lines = [line for file in (tmp_path / "t").glob("part-*") for line in file.read_text().splitlines() if line]
    assert len([line for line in lines if line != "user_id,movie_id,tag"]) == len(BREAKS)
    with pytest.raises(ValueError, match="keep"):
        write_csv(df, str(tmp_path / "u"), line_breaks="keep")


def test_a_failed_overwrite_leaves_the_old_table(spark, tmp_path):
    path = tmp_path / "t"
    write_csv(spark.range(5).toDF("n"), str(path))
    bad = spark.range(100).selectExpr("if(id = 97, raise_error('no'), id) as n").repartition(4)
    with pytest.raises(Exception, match="no"):
        write_csv(bad, str(path))
    assert rows(read_result(spark, "n long", str(path))) == [(n,) for n in range(5)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_table_may_be_made_from_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    write_csv(spark.range(5).toDF("n"), path)
    write_csv(read_result(spark, "n long", path).selectExpr("n * 2 as n"), path)
    write_csv(read_result(spark, "n long", path).selectExpr("n + 1 as n"), path + "/", single_file=True)
    assert rows(read_result(spark, "n long", path)) == [(1,), (3,), (5,), (7,), (9,)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_bad_lines_are_set_apart(spark, tmp_path):
    (tmp_path / "r").mkdir()
    head = "userId,movieId,rating,timestamp\n"
    (tmp_path / "r" / "a.csv").write_text(head + "1,2,4.5,9\n1,3,oops,9\n1,4\n2,2,,9\n3,3,1.0,9,9\n")
    (tmp_path / "r" / "b.csv").write_text(head + '"1","2","3.5",8\n,,,\n"1,2",3,x y,7\n')
    found = read_csv_checked(spark, "ratings", str(tmp_path / "r"))
    assert rows(found.rows) == [("1", "2", 3.5), ("1", "2", 4.5), ("2", "2", None), (None, None, None)]
    assert found.rows.schema == SCHEMAS["ratings"]
    assert rows(found.bad_lines) == [("a.csv", "1,3,oops,9"), ("a.csv", "1,4"), ("a.csv", "3,3,1.0,9,9"), ("b.csv", '"1,2",3,x y,7')]
    assert rows(found.counts()) == [("a.csv", 3), ("b.csv", 1)]
    assert found.bad_lines.count() == 4 and found.rows.select("rating").count() == 4


@pytest.mark.parametrize(("table", "text", "good", "bad"), [
    ("ratings", "userId,movieId,rating\n1,2,3.0\n1,2,3.0,4\n", 1, 1),
    ("tags", "userId,movieId,tag,timestamp\n1,2,a,3\n1,2,a\n", 1, 1),
    ("genome_scores", "movieId,tagId,relevance\n1,1,0.5\n1,1,half\n", 1, 1),
    ("movies", "year,genres,movieId,title\n1990,a|b,1,X\n1990,a|b,1\n", 1, 1),
    ("genome_tags", "tagId,tag\n1,a\n2,\"b, c\"\n", 2, 0),
])
def test_bad_lines_of_every_table(spark, tmp_path, table, text, good, bad):
    (tmp_path / "t.csv").write_text(text)
    found = read_csv_checked(spark, table, str(tmp_path / "t.csv"))
    assert (found.rows.count(), found.bad_lines.count()) == (good, bad)


def test_columns_by_header_name(spark, tmp_path):
    (tmp_path / "m.csv").write_text('year,GENRES,movieId,title\n1995,Comedy|Drama,7,"Heat, The"\n')
    assert rows(read_csv(spark, "movies", str(tmp_path / "m.csv"))) == [("7", "Heat, The", "Comedy|Drama")]
    (tmp_path / "g.csv").write_text("tag,tagId\nfunny,1\n")
    assert rows(read_csv(spark, "genome_tags", str(tmp_path / "g.csv"))) == [("1", "funny")]
    (tmp_path / "bad.csv").write_text("movieId,name,genres\n1,x,y\n")
    with pytest.raises(ValueError, match="title"):
        read_csv(spark, "movies", str(tmp_path / "bad.csv"))


def test_published_layout(spark, tmp_path):
    (tmp_path / "movies.csv").write_text(
        'movieId,title,genres\n1,"American ""President"", The (1995)",Comedy|Drama\n'
    )
    (tmp_path / "ratings.csv").write_text(
        "userId,movieId,rating,timestamp\n1,1,4.0,1225734739\n1,2,oops,1225734740\n2,1,3.5\n"
    )
    (tmp_path / "tags.csv").write_text(
        'userId,movieId,tag,timestamp\n14,110,"epic, ""great""",1443148538\n'
    )
    (tmp_path / "genome-scores.csv").write_text("movieId,tagId,relevance\n1,1,0.032\n")
    (tmp_path / "genome-tags.csv").write_text('tagId,tag\n1,007\n2,"007, (series)"\n')
    tables = read_csv_tables(spark, str(tmp_path))
    assert rows(tables.movies) == [("1", 'American "President", The (1995)', "Comedy|Drama")]
    assert rows(tables.ratings) == [("1", "1", 4.0), ("1", "2", None), ("2", "1", 3.5)]
    assert rows(tables.tags) == [("14", "110", 'epic, "great"')]
    assert rows(tables.genome_scores) == [("1", "1", 0.032)]
    assert rows(tables.genome_tags) == [("1", "007"), ("2", "007, (series)")]


def test_modes_and_single_file(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id % 7 as k").repartition(5)
    path = tmp_path / "out"
    write_csv(df, str(path), "errorifexists")
    with pytest.raises(Exception, match="(?i)already exists"):
        write_csv(df, str(path), "errorifexists")
    write_csv(df, str(path), single_file=True)
    assert len(list(path.glob("part-*.csv"))) == 1
    assert spark.read.option("header", True).csv(str(path)).count() == 100


def test_staging_measures_and_uses_the_named_folder(spark):
    staged = stage_measured(spark.createDataFrame([("ab", 1), (None, 22)], "s string, n int"))
    assert (staged.rows, staged.bytes) == (2, 2 * (64 + 2 * 8) + 8)
    assert rows(staged.df) == [("ab", 1), (None, 22)]
    assert staging_path(spark, "x").startswith(staging_root(spark) + "/x-")
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir")
    empty = stage_measured(spark.createDataFrame([], "s string"))
    assert (empty.rows, empty.bytes) == (0, 0) and rows(empty.df) == []


def test_short_texts_arrays_and_binaries_are_not_small(spark):
    short = stage_measured(spark.range(1000).selectExpr("'a' as s"))
    assert short.bytes >= 64 * 1000
    arrays = stage_measured(spark.range(100).selectExpr("transform(sequence(1, 1000), x -> x + 0.123456789D) as a"))
    assert arrays.bytes >= 100 * 1000 * 8
    binary = stage_measured(spark.range(10).selectExpr("cast(repeat('x', 5000) as binary) as b"))
    assert binary.bytes >= 10 * 5000


def test_staged_tables_are_deleted(spark):
    import os

    path = stage_measured(spark.range(3)).df.inputFiles()[0].removeprefix("file:")
    assert os.path.exists(path)
    clear_staged(spark)
    assert not os.path.exists(path)


@pytest.fixture
def table_folder(spark, tmp_path):
    """A small world in which every query of the batch finds something."""
    users, movies = range(40), range(12)
    data = {
        "movies": [(str(m), f"M{m}", "g|h" if m % 2 else "g") for m in movies],
        "ratings": [
            (str(u), str(m), 1.0 if m == 3 else 4.5 if (u + m) % 3 else 5.0)
            for u in users
            for m in movies
        ],
        "tags": [(str(u), str(m), f"t{u % 2}") for u in users for m in movies],
        "genome_scores": [
            (str(m), str(t), 0.9 if (m + t) % 2 or m == 3 else 0.05 * t) for m in movies for t in range(4)
        ],
        "genome_tags": [("0", "action"), ("1", "classic"), ("2", "thriller"), ("3", "other")],
    }
    for name, table in data.items():
        df = spark.createDataFrame(table, SCHEMAS[name])
        write_csv(df, str(tmp_path / "csv" / f"{name.replace('genome_', 'genome-')}.csv"))
        df.write.parquet(str(tmp_path / "parquet" / f"{name}.parquet"))
    return tmp_path


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_command_line_runs_all_queries(spark, table_folder, kind, capsys):
    out = table_folder / f"out-{kind}"
    main(["--input", str(table_folder / kind), "--output", str(out), "--format", kind,
          "--target", "5", "--top", "3"])
    names = {
        "iceberg_tag_genre", "dominant_tag_per_genre", "iceberg_relevant_tags", "tag_sentiment",
        "skyline_tag_genre", "skyline_movies", "corr_relevance_rating", "movie_rating_relevance",
        "user_target_cosine", "overhyped_movies", "topk_users",
    }
    assert {line.split(":")[0] for line in capsys.readouterr().out.splitlines()} == names

    def result(name):
        return rows(spark.read.option("header", True).csv(str(out / name)))

    assert {tag for tag, genre, _ in result("iceberg_tag_genre")} == {"t0", "t1"}
    assert {genre for _, genre, _ in result("dominant_tag_per_genre")} == {"g", "h"}
    assert len(result("tag_sentiment")) == 2
    assert len(result("movie_rating_relevance")) == 12
    assert len(result("corr_relevance_rating")) == 1
    assert [row[0] for row in result("overhyped_movies")] == ["3"]
    assert [row[2] for row in result("topk_users")] == ["1", "2", "3"]
    assert len(result("user_target_cosine")) == 40
    assert result("skyline_movies")
    assert read_parquet_tables(spark, str(table_folder / "parquet")).ratings.count() == 480


def test_command_line_sets_bad_lines_apart(spark, table_folder):
    (table_folder / "csv" / "ratings.csv" / "more.csv").write_text("user_id,movie_id,rating\n1,2,five\n")
    out = table_folder / "out"
    main(["--input", str(table_folder / "csv"), "--output", str(out), "--target", "5", "--quarantine", str(table_folder / "bad")])
    assert [r[1] for r in rows(read_result(spark, "file string, line string", str(table_folder / "bad" / "ratings")))] == ["1,2,five"]
    assert rows(read_result(spark, "file string, line string", str(table_folder / "bad" / "tags"))) == []
    assert spark.read.option("header", True).csv(str(out / "tag_sentiment")).count() == 2


def test_the_batch_deals_ratings_by_movie_once(spark, table_folder):
    """What else needs ratings by movie reads their averages and counts."""
    before = last_execution(spark)
    main(["--input", str(table_folder / "parquet"), "--output", str(table_folder / "o"), "--format", "parquet", "--target", "5"])
    grouped = [p for p in executed_plans(spark, before) if "ratings.parquet" in p and "hashpartitioning(movie_id" in p]
    assert len([p for p in grouped if "avg(rating" in p]) == 1
