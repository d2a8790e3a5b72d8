"""The jobs end to end on small files."""

import random

import pytest

from opinara.operators.sentiment import FULL
from opinara.plans import jobs


def _reviews(path):
    blocks = [
        ("A", "good plot and good music"), ("A", "plot not good"), ("B", "bad sound"), ("C", "the of"),
    ]
    path.write_text("\n\n".join(f"product/productId: {p}\nreview/text: {t}" for p, t in blocks) + "\n")


def test_aspects_and_sentiment(spark, tmp_path):
    _reviews(tmp_path / "r.txt")
    (tmp_path / "lex.txt").write_text("good\t1.9\t0.9\t[1]\nbad\t-2.5\t0.6\t[2]\nbad\t-2.0\t0.6\t[2]\n")
    jobs.aspects_job(spark, str(tmp_path / "r.txt"), str(tmp_path / "a"), single_file=True)
    rows = {tuple(r) for r in spark.read.csv(str(tmp_path / "a"), sep="\t").collect()}
    assert rows == {("A", "[good, plot, music]"), ("B", "[bad, sound]"), ("C", "[]")}
    jobs.sentiment_job(spark, str(tmp_path / "r.txt"), str(tmp_path / "lex.txt"), str(tmp_path / "s"), FULL)
    found = spark.read.csv(str(tmp_path / "s"), header=True, schema="products string, compoundscore double")
    scores = {r["products"]: r["compoundscore"] for r in found.collect()}
    total = 1.9 + 1.9 - 1.9 * 0.74
    assert scores == {
        "A": round(total / (total**2 + 15) ** 0.5, 4), "B": round(-2 / 19**0.5, 4), "C": 0.0,
    }


@pytest.mark.parametrize("training", [{"skip_gram": True, "iters": 1}, {"rounds": 3, "shift": 0.5}])
def test_dictionary(spark, tmp_path, training):
    rng = random.Random(1)
    words = "wide broad narrow road street house".split()
    lines = [" ".join(rng.choice(words) for _ in range(8)) for _ in range(50)]
    (tmp_path / "c.txt").write_text("\n".join(lines))
    (tmp_path / "lex.txt").write_text("road\t1.5\t0.45\t[1, 2]\nhouse\t-0.5\t0.9\t[2]\n")
    jobs.dictionary_job(
        spark, str(tmp_path / "c.txt"), str(tmp_path / "lex.txt"), str(tmp_path / "new"),
        skip=0, partitions=2, dim=8, **training,
    )
    rows = {r[0]: tuple(r)[1:] for r in spark.read.csv(str(tmp_path / "new"), sep="\t").collect()}
    assert set(rows) == {"road", "house", "broad", "narrow", "street"}
    assert len({rows[w] for w in ("road", "broad", "narrow", "street")}) == 1


def test_recommendation(spark, tmp_path):
    lines = [f"{u},{i},{(u % 3 + 1) * (i % 4 + 1)}" for u in range(20) for i in range(15) if (u + i) % 4]
    (tmp_path / "r.csv").write_text("user,item,rating\n" + "\n".join(lines) + "\n,3,1\n")
    best = jobs.recommendation_job(
        spark, str(tmp_path / "r.csv"), str(tmp_path / "out"), ranks=(2,), regs=(0.01, 9.0), final_iters=12, k=3
    )
    assert best["reg"] == 0.01
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(rows) == 20 and all(len(r["recommended"]) == 3 for r in rows)


def test_pages_to_json_and_stream(spark, tmp_path):
    html = '<h1><span id="productTitle">T</span></h1><div data-hook="review"><div data-hook="review-collapsed">ok</div></div>'
    rows = [(1, "u1", 200, html), (2, "u2", 404, ""), (3, "u1", 200, html)]
    pages = spark.createDataFrame(rows, "page_id long, url string, status int, html string")
    pages.write.parquet(str(tmp_path / "pages"))
    jobs.extraction_job(spark, str(tmp_path / "pages"), str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).where("error is not null").count() == 1
    jobs.publish_job(spark, str(tmp_path / "pages"), {"path": str(tmp_path / "topic")}, fmt="text")
    query = jobs.review_stream_job(
        spark, {"path": str(tmp_path / "topic")}, str(tmp_path / "cp"), str(tmp_path / "out"), fmt="text"
    )
    query.awaitTermination(120)
    found = {(r["url"], r["name"], r["review_text"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found == {("u1", "T", "ok"), ("u2", None, None)}


def test_lookup(spark, tmp_path):
    def save(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))

    save("recommendations", [(1, [2, 1])], "user_id int, rec_prods array<int>")
    save("users", [(1, "ann")], "user_id int, user string")
    save("products", [(1, "A"), (2, "B")], "pro_id int, product string")
    save("titles", [("A", "first")], "movie string, title string")
    rows = jobs.lookup_job(spark, str(tmp_path)).orderBy("rank").collect()
    assert [tuple(r)[2:] for r in rows] == [(1, "B", "TITLE NOT AVAILABLE"), (2, "A", "first")]


def test_text_ids_from_ratings_to_titled_rows(spark, tmp_path):
    lines = [f"A{u},B{i:03d}-{10**10 + i},{(u % 3 + 1) * (i % 4 + 1)}" for u in range(12) for i in range(9) if (u + i) % 4]
    (tmp_path / "r.csv").write_text("user,item,rating\n" + "\n".join(lines) + "\n")
    serving = str(tmp_path / "serving")
    jobs.recommendation_job(
        spark, str(tmp_path / "r.csv"), str(tmp_path / "out"), ranks=(2,), regs=(0.01,), final_iters=5, k=3, serving=serving
    )
    titles = spark.createDataFrame([(f"B{i:03d}-{10**10 + i}", f"title {i}") for i in range(9)], "movie string, title string")
    titles.write.parquet(f"{serving}/titles")
    rows = jobs.lookup_job(spark, serving).collect()
    assert len(rows) == 36 and {r["user"] for r in rows} == {f"A{u}" for u in range(12)}
    assert all(r["title"] == f"title {int(r['product'][1:4])}" for r in rows)
