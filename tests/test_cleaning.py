import pytest
from pyspark.sql import functions as F

from filmloom import schemas
from filmloom.functions import coercion, literals, text
from filmloom.operators import cleaning
from filmloom.plans.catalog import clean_catalog
from filmloom.sources import readers, writers


def _values(spark, rows, column, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("c"))).collect()]


def test_literal_lists(spark):
    cells = [
        "[{'id': 16, 'name': 'Animation'}]",
        '[{"id": 1, "name": "A"}]',
        """[{'id': 1, 'name': "Schindler's"}, {'id': 2, 'name': 'B'}]""",
        "[{'id': None, 'name': 'x'}, {'id': 3, 'flag': True, 'name': 'y: None of it'}]",
        r"[{'id': 4, 'name': 'L\'Atalante'}, {'id': 5, 'name': 'a\xa0b'}]",
        "[]",
        "{}",
        "",
        None,
        "garbage [",
        "{'id': 10, 'name': 'One object'}",
        "[{'id': 7}, {'name': 'kept'}]",
        "['just', 'text']",
    ]
    got = _values(spark, cells, lambda c: literals.extract_names(literals.parse_literal_list(c, schemas.NAMED_ENTITY)))
    assert got == [
        ["Animation"], ["A"], ["Schindler's", "B"], ["x", "y: None of it"], ["L'Atalante", "a\xa0b"],
        [], [], [], [], [], [], ["kept"], [],
    ]


def test_ids_and_numbers(spark):
    cells = ["862", "1997-08-20", "1.0", " 7 ", None, "", "1d", "nan", "9007199254740993"]
    assert _values(spark, cells, coercion.coerce_id) == [862, None, 1, 7, None, None, None, None, 9007199254740993]
    assert _values(spark, ["1e3", ".5", "abc", "0x10"], coercion.coerce_numeric) == [1000.0, 0.5, None, None]


def test_value_rules(spark):
    runtime = _values(spark, [0.5, 1.0, 600.0, 601.0, None], lambda c: coercion.range_to_null(c, 1, 600), "double")
    assert runtime == [None, 1.0, 600.0, None, None]
    assert _values(spark, [0.0, 5.0], coercion.zero_to_null, "double") == [None, 5.0]
    assert _values(spark, [" TRUE ", "False", "junk", None], coercion.text_to_boolean) == [True, False, None, None]
    rated = _values(spark, [0.0, 0.5, 5.0, 5.5, 3.3, None], cleaning.valid_rating, "double")
    assert rated == [False, True, True, False, True, False]
    days = [str(x) if x else None for x in _values(spark, ["1995-10-30", "1", "2001-02-30", None], coercion.parse_release)]
    assert days == ["1995-10-30", None, None, None]


def test_text_functions(spark):
    genres = _values(spark, ["Action|Sci-Fi", "['Drama', \"Comedy\"]", "", None, "[]"], text.genre_list)
    assert genres == [["Action", "Sci-Fi"], ["Drama", "Comedy"], [], [], []]
    assert _values(spark, ["Heat (1995)", "Heat"], text.year_from_title) == [1995, None]
    assert _values(spark, ["tt0114709", "tt", None], coercion.imdb_number) == [114709, None, None]
    assert _values(spark, ["u12@x3.org", "none@"], coercion.digits_to_id) == [123, -1]
    assert _values(spark, ["/a.jpg", " ", None], text.poster_url) == [text.POSTER_PREFIX + "/a.jpg", None, None]
    assert _values(spark, ["x" * 31, "short", None], text.preview) == ["x" * 30 + "…", "short", "NULL"]


def _write(path, header, rows):
    def cell(v):
        return "" if v is None else '"' + str(v).replace('"', '""') + '"'

    path.write_text("\n".join([header, *[",".join(cell(v) for v in r) for r in rows]]) + "\n", encoding="utf-8")


@pytest.fixture()
def raw_folder(tmp_path):
    _write(
        tmp_path / "movies_metadata.csv",
        "adult,budget,genres,id,imdb_id,original_language,original_title,overview,popularity,production_companies,"
        "production_countries,release_date,revenue,runtime,spoken_languages,status,tagline,title,video,vote_average,vote_count",
        [
            ["False", "0", "[{'id': 1, 'name': 'Drama'}]", "862", "tt0114709", "en", "Toy", "two\nlines, \"quoted\"", "21.9",
             "[]", "[{'iso_3166_1': 'US', 'name': 'USA'}]", "1995-10-30", "373554033", "81",
             "[{'iso_639_1': 'en', 'name': 'English'}]", "Released", None, " Toy Story ", "False", "7.7", "5415"],
            ["False", "5", "[]", "862", None, "en", "Toy", "", "1", "[]", "[]", "1995-10-30", "0", "81", "[]",
             "Released", "", "Zzz duplicate", "False", "7.7", "1"],
            ["junk", "x", None, "1997-08-20", None, "en", "bad", "", "1", "[]", "[]", "1", "0", "0", "[]", "", "", "Bad", "", "", ""],
            ["True", "9", "[{'name': 'Action'}]", "10", None, "fr", "Ten", "", "3", "[]", "[]", "", "0", "601", "[]", "", "", "Ten", "True", "5", "2"],
        ],
    )
    _write(
        tmp_path / "credits.csv",
        "cast,crew,id",
        [
            ["[{'cast_id': 14, 'character': ' Woody ', 'gender': 2, 'id': 31, 'name': 'Tom', 'order': 0, 'profile_path': None}]",
             "[{'department': 'Directing', 'gender': 2, 'id': 7, 'job': 'Director', 'name': 'John', 'profile_path': '/j'}]", "862"],
            ["[]", "[]", "10"],
        ],
    )
    _write(tmp_path / "keywords.csv", "id,keywords", [["862", "[{'id': 931, 'name': 'jealousy'}, {'id': 4290, 'name': 'toy'}]"]])
    _write(
        tmp_path / "ratings.csv",
        "userId,movieId,rating,timestamp",
        [["1", "1", "5.0", "1260759144"], ["1", "2", "4.0", "1260759145"], ["1", "1", "3.0", "1260759999"],
         ["2", "1", "5.5", "1"], ["2", "3", "0.5", ""], ["x", "1", "4", "1"], ["3", "4", "4.0", "1"]],
    )
    # Films 1 and 2 lead to one catalog id, film 4 to none.
    _write(tmp_path / "links.csv", "movieId,imdbId,tmdbId", [["1", "114709", "862"], ["2", "1", "862"], ["3", "2", "10"], ["4", "3", ""]])
    return tmp_path


def test_clean_catalog_end_to_end(spark, raw_folder):
    out = f"{raw_folder}/out"
    counts = clean_catalog(spark, str(raw_folder), out)
    assert counts == {
        "movies_clean": 2, "cast_clean": 1, "crew_clean": 1, "keywords_clean": 2,
        "ratings_clean": 4, "links_clean": 4, "movies": 2, "ratings": 2,
    }
    toy = spark.read.parquet(f"{out}/movies").where("movie_id = 862").first()
    assert toy["title"] == "Toy Story" and toy["genre_names"] == ["Drama"] and toy["budget"] is None
    assert toy["production_country_codes"] == ["US"] and toy["release_year"] == 1995 and toy["tagline"] is None
    assert spark.read.parquet(f"{out}/movies").where("movie_id = 10").first()["runtime"] is None
    rated = {(r.user_id, r.movie_id): r for r in spark.read.parquet(f"{out}/ratings").collect()}
    assert set(rated) == {(1, 862), (2, 10)}
    assert rated[1, 862]["movielens_id"] == 1 and rated[1, 862]["rating"] == 5.0 and rated[2, 10]["timestamp"] is None


def test_readers_and_writers(spark, raw_folder, tmp_path):
    clean_catalog(spark, str(raw_folder), f"{tmp_path}/p")
    assert readers.read_ratings(spark, f"{tmp_path}/p").count() == 2
    assert readers.read_ratings(spark, f"{tmp_path}/p", max_rows=1).count() == 1
    assert readers.read_ratings(spark, f"{tmp_path}/nothing").columns == ["user_id", "movie_id", "rating"]
    with pytest.raises(FileNotFoundError):
        readers.read_first_existing(spark, [(f"{tmp_path}/a", {})])
    with pytest.raises(FileNotFoundError):
        readers.read_movielens(spark, f"{tmp_path}/p")
    clean_catalog(spark, str(raw_folder), f"{tmp_path}/c", fmt="csv")
    again = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{tmp_path}/c/movies")
    assert again.where("movie_id = 862").first()["genre_names"] == "['Drama']"
    n, shown = readers.preview_table(spark.read.parquet(f"{tmp_path}/p/movies").orderBy("movie_id"))
    assert n == 2 and shown.first()["imdb_id"] == "NULL"


def test_saved_tables_fit_their_layout(spark, raw_folder, tmp_path):
    clean_catalog(spark, str(raw_folder), f"{tmp_path}/p")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS filmtest LOCATION '{tmp_path}/db'")
    tables = {n: spark.read.parquet(f"{tmp_path}/p/{n}") for n in ("movies", "ratings")}
    writers.save_tables(spark, tables, "filmtest", {"ratings": (2, "movie_id")})
    assert dict(spark.table("filmtest.ratings").dtypes)["rating"] == "decimal(3,1)"
    assert dict(spark.table("filmtest.movies").dtypes)["release_year"] == "smallint"
    writers.save_model({"items": tables["movies"].select("movie_id")}, f"{tmp_path}/m")
    assert writers.load_model(spark, f"{tmp_path}/m", ["items"])["items"].count() == 2


def test_profiles(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"email": "a@b", "favorite_genres": ["Drama"], "age_preference": "any", "ratings": {"862": 4.5, "x": 1}, "favorites": [1, 2]}'
    )
    ratings, favorites = readers.profiles_to_ratings(readers.read_profiles(spark, str(tmp_path / "p.json")))
    assert [(r.movie_id, r.rating) for r in ratings.collect()] == [(862, 4.5)]
    assert sorted(r.movie_id for r in favorites.collect()) == [1, 2]


def test_lists_with_quotes_survive_csv(spark, tmp_path):
    from filmloom.sources.writers import write_table

    names = ["Schindler's List", "back\\slash", 'double "quoted"', "plain"]
    write_table(spark.createDataFrame([(1, names)], "id int, names array<string>"), str(tmp_path / "t"), "csv")
    row = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "t")).first()
    import ast

    assert ast.literal_eval(row["names"]) == names


def test_raw_films_are_dealt_out(spark, tmp_path):
    """A table in one small file still makes raw files of bounded size, with all films."""
    from filmloom.workload.rows import _raw_tables

    part = spark.range(25_000).selectExpr(
        "id AS p_partkey", "'a' AS p_name", "'b' AS p_brand", "'c' AS p_type", "1 AS p_size", "1.0D AS p_retailprice"
    )
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    orders = spark.createDataFrame([(1, 2, "2000-01-01")], "o_orderkey bigint, o_custkey bigint, o_orderdate string")
    orders.selectExpr("o_orderkey", "o_custkey", "CAST(o_orderdate AS date) AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    lines = spark.createDataFrame([(1, 3, 1, 5.0)], "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    for films in _raw_tables(spark, str(tmp_path))[:3]:
        assert films.rdd.getNumPartitions() == 3 and films.select("id").distinct().count() == 25_000
