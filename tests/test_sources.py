import gzip

import pytest
from pyspark.sql import functions as F

from opinara.operators import lexicon
from opinara.sources import readers, writers


def _block(i, text):
    return f"product/productId: P{i:05d}\nreview/userId: u\nreview/score: 5.0\nreview/text: {text}"


def test_reviews_stay_with_their_product_over_many_splits(spark, tmp_path):
    path = tmp_path / "movies.txt"
    blocks = [_block(i, f"text {i} productId: x " + "y" * (i % 97)) for i in range(400)]
    path.write_text("\n\n".join(blocks))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 5
        rows = readers.read_reviews(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 400 and len({r["review_id"] for r in rows}) == 400
    assert all(r["review_text"].startswith(f"text {int(r['product_id'][1:])} ") for r in rows)


def test_review_edge_records(spark, tmp_path):
    path = tmp_path / "r.txt"
    path.write_text(
        "product/productId: A\nreview/text: \n\nproduct/productId: B\nreview/score: 1\n\n\n"
        "product/productId: C\r\nreview/text: fine\r\n\nreview/summary: lonely\n"
    )
    rows = {r["product_id"]: r["review_text"] for r in readers.read_reviews(spark, str(path)).collect()}
    assert rows == {"A": "", "B": None, "C": "fine"}


def test_ratings_lines_and_product_list(spark, tmp_path):
    (tmp_path / "r.csv").write_text("user,item,rating\n1,2,3.5\n4,,1\n")
    rows = readers.read_ratings(spark, str(tmp_path / "r.csv")).collect()
    assert [tuple(r) for r in rows] == [(1, 2, 3.5), (4, None, 1.0)]
    with gzip.open(tmp_path / "d.txt.gz", "wt") as f:
        f.write("".join(f"line {i}\n" for i in range(100)))
    lines = readers.read_lines(spark, str(tmp_path / "d.txt.gz"), partitions=4)
    assert lines.count() == 100 and lines.rdd.getNumPartitions() > 1
    (tmp_path / "p.csv").write_text("productId,other\nB00,1\nB01,2\n")
    ids = readers.read_product_list(spark, str(tmp_path / "p.csv")).collect()
    assert [r["productId"] for r in ids] == ["B00", "B01"]


def test_lexicon_line_numbers_over_splits(spark, tmp_path):
    path = tmp_path / "lex.txt"
    lines = [f"w{i}\t{i % 5}.5\t0.{i:03d}\t[1, 2]" for i in range(500)]
    lines[7] = ""
    lines[9] = "broken\t1.0\t0.3"
    lines[11] = "nan\tx\t0.3\t[1]"
    path.write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = readers.read_lexicon(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 497
    assert all(r["token"] == f"w{r['line_no'] - 1}" for r in rows)


def test_delimited_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("p", ["a", "b"]), ("q", [])], "product_id string, noun array<string>")
    out = str(tmp_path / "aspects")
    writers.write_delimited(df, out, single_file=True)
    back = {tuple(r) for r in spark.read.csv(out, sep="\t").collect()}
    assert back == {("p", "[a, b]"), ("q", "[]")}
    assert len(list((tmp_path / "aspects").glob("part-*"))) == 1
    out2 = str(tmp_path / "scores")
    scores = spark.createDataFrame([("p", 0.5)], "products string, compoundscore double")
    writers.write_delimited(scores, out2, sep=",", header=True)
    assert spark.read.csv(out2, header=True).first().asDict() == {"products": "p", "compoundscore": "0.5"}


def test_recommendations_and_products_round_trip(spark, tmp_path):
    recs = spark.createDataFrame([(1, [3, 2])], "user int, recommended array<int>")
    writers.write_recommendations(recs, str(tmp_path / "recs"))
    back = spark.read.parquet(str(tmp_path / "recs"))
    assert back.dtypes[1][1] == "array<int>" and back.first()["recommended"] == [3, 2]
    products = recs.select(F.lit("u").alias("url"), F.create_map(F.lit("5"), F.lit("1%")).alias("ratings"))
    writers.write_products_json(products, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).first()["ratings"]["5"] == "1%"


def test_lexicon_round_trip(spark, tmp_path):
    (tmp_path / "l.txt").write_text('"q\t1.5\t0.2\t[1, 2]\nb\t-2.0\t0.4\t[3]\n')
    lex = readers.read_lexicon(spark, str(tmp_path / "l.txt"))
    writers.write_lexicon(lex, str(tmp_path / "out"))
    back = readers.read_lexicon(spark, str(tmp_path / "out"))
    cols = ["token", "valence", "sd", "raw"]
    assert {tuple(r) for r in back.select(cols).collect()} == {tuple(r) for r in lex.select(cols).collect()}


def _split_into(spark, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    return lambda: spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("style", ["lf", "crlf", "mixed", "blanks"])
def test_records_survive_any_line_ends_over_many_splits(spark, tmp_path, style):
    ends = {"lf": ["\n"], "crlf": ["\r\n"], "mixed": ["\n", "\r\n"], "blanks": ["\n"]}[style]
    text = ""
    for i in range(300):
        end = ends[i % len(ends)]
        text += _block(i, f"text {i} " + "y" * (i % 61)).replace("\n", end) + end
        text += (" \t" if style == "blanks" and i % 2 else "") + end * (1 + i % 2)
    (tmp_path / "r.txt").write_bytes(text.encode())
    restore = _split_into(spark, 900)
    try:
        rows = readers.read_reviews(spark, str(tmp_path / "r.txt")).collect()
    finally:
        restore()
    assert {r["product_id"]: r["review_text"] for r in rows} == {
        f"P{i:05d}": f"text {i} " + "y" * (i % 61) for i in range(300)
    }
    assert len(rows) == 300 and len({r["review_id"] for r in rows}) == 300


def test_ratings_by_name_and_without_silent_loss(spark, tmp_path):
    (tmp_path / "r.csv").write_text("item,rating,user\n2,3.5,1\n,1,4\n")
    rows = readers.read_ratings(spark, str(tmp_path / "r.csv")).collect()
    assert [tuple(r) for r in rows] == [(1, 2, 3.5), (4, None, 1.0)]
    for bad in ("A1,2,3", "3000000000,2,3", "1,2,many"):
        (tmp_path / "bad.csv").write_text(f"user,item,rating\n{bad}\n")
        with pytest.raises(Exception, match="not a"):
            readers.read_ratings(spark, str(tmp_path / "bad.csv")).collect()
    (tmp_path / "k.csv").write_text("user,item,rating\nA1,3000000000,3\n")
    assert readers.read_ratings(spark, str(tmp_path / "k.csv"), keyed=True).collect() == [("A1", "3000000000", 3.0)]


def test_grown_lexicon_file_keeps_every_old_line(spark, tmp_path):
    old = ["; a comment", "", "word\t1.9\t0.2\t[1, 2]", "short\t1", "deep\t1.2345\t0.44957\t[3]", "big\t1500\t0.5\t[4]"]
    (tmp_path / "l.txt").write_text("\n".join(old) + "\n")
    lines = readers.read_lexicon_lines(spark, str(tmp_path / "l.txt"))
    known = lexicon.parse_lexicon(lines)
    assert {r["token"]: float(r["valence"]) for r in known.collect()} == {"word": 1.9, "deep": 1.2345, "big": 1500.0}
    vectors = spark.createDataFrame(
        [("seed", [1.0, 0.0]), ("comment", [1.0, 0.1]), ("fresh", [1.0, 0.2])], "word string, vector array<double>"
    )
    rows = lexicon.new_entries(known, vectors, "seed", n=2, skip=0, lines=lines)
    writers.write_lexicon(rows, str(tmp_path / "out"), lines=lines)
    new = readers.read_lexicon_lines(spark, str(tmp_path / "out")).orderBy("line_no").collect()
    # "comment" stands in a line that is no entry, so only "fresh" is new.
    assert [r["value"] for r in new] == [*old, "fresh\t1.2345\t0.44957\t[3]"]


@pytest.mark.parametrize("bounds", [(0, 99), (-7, 3), (5, 5), (None, None), (0, 1)])
@pytest.mark.parametrize("parts", [1, 2, 7])
def test_range_predicates_are_complete_and_disjoint(spark, bounds, parts):
    """Also rows without an id and rows that came in after the bounds were read."""
    rows = spark.range(-20, 130).select(F.col("id").alias("k")).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k"))
    predicates = readers.range_predicates("k", *bounds, parts)
    assert len(predicates) <= parts
    met = sum(F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates)
    assert rows.where(met != 1).count() == 0


def test_hash_predicates_are_complete_and_disjoint(spark):
    rows = spark.range(500).select(F.nullif(F.col("id").cast("string"), F.lit("17")).alias("movie"))
    for parts in (1, 5):
        predicates = readers.hash_predicates("CRC32(movie)", parts)
        sizes = [rows.where(p).count() for p in predicates]
        assert len(sizes) == parts and sum(sizes) == 500 and min(sizes) > 60
