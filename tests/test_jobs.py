"""The command-line jobs write the original outputs."""

import os

from conftest import FIXTURES
from quarry import jobs

J, P = FIXTURES / "ratings_java", FIXTURES / "ratings_python"


def read_parts(path):
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    return "".join(open(os.path.join(path, p), encoding="utf-8").read() for p in parts).splitlines()


def test_key_value_jobs(spark, tmp_path):
    ratings = f"{J}/ratings_1.txt,{J}/ratings_2.txt"
    jobs.main(["gender-stats", ratings, f"{J}/users.txt", f"{J}/movies.txt", str(tmp_path / "g")])
    assert read_parts(tmp_path / "g") == (J / "expected_gender_stats.txt").read_text(encoding="utf-8").splitlines()
    jobs.main(["age-stats", ratings, f"{J}/users.txt", f"{J}/movies.txt", str(tmp_path / "a")])
    assert read_parts(tmp_path / "a") == (J / "expected_age_stats.txt").read_text(encoding="utf-8").splitlines()


def test_report_jobs(spark, tmp_path):
    ratings = f"{P}/ratings_1.txt,{P}/ratings_2.txt"
    jobs.main(["age-report", ratings, f"{P}/users.txt", f"{P}/movies.txt", str(tmp_path / "r")])
    assert read_parts(tmp_path / "r") == (P / "expected_report_4.txt").read_text(encoding="utf-8").splitlines()
    jobs.main(["year-report", ratings, str(tmp_path / "y")])
    assert read_parts(tmp_path / "y") == (P / "expected_report_6.txt").read_text(encoding="utf-8").splitlines()


def test_review_jobs(spark, tmp_path):
    from test_reviews import ROWS, STOP
    (tmp_path / "r.csv").write_text(ROWS, encoding="utf-8")
    (tmp_path / "s.txt").write_text(STOP, encoding="utf-8")
    jobs.clean_words(spark, str(tmp_path / "r.csv"), str(tmp_path / "clean"), stopwords=str(tmp_path / "s.txt"))
    jobs.review_stats(spark, str(tmp_path / "r.csv"), str(tmp_path / "stats"), cleaned=str(tmp_path / "clean"),
                      threshold=1)
    assert sorted(read_parts(tmp_path / "stats" / "frequent_words")) == sorted(
        ["phòng,3", "nhân,2", "viên,2", "thân,2", "thiện,2"])
    assert sorted(read_parts(tmp_path / "stats" / "per_category")) == sorted(
        ["HOTEL,3", "ROOMS,2", "SERVICE,1", ",1"])
    jobs.top_aspect(spark, str(tmp_path / "r.csv"), str(tmp_path / "top"))
    assert read_parts(tmp_path / "top") == ["HOTEL,2", "ROOMS,2"]
    jobs.top_words_sentiment(spark, str(tmp_path / "r.csv"), str(tmp_path / "pos"), str(tmp_path / "neg"),
                             stopwords=str(tmp_path / "s.txt"))
    assert "COMFORT,{(COMFORT,bẩn,1),(COMFORT,phòng,1),(COMFORT,ồn,1)}" in read_parts(tmp_path / "neg")


def test_commerce_job(spark, tmp_path):
    folder = tmp_path / "shop"
    folder.mkdir()
    (folder / "Orders.csv").write_text("Order_ID;Customer_Trx_ID;Order_Purchase_Timestamp\n"
                                       "o1;c1;2024-01-05 10:00\no2;c1;2024-02-10 11:30\n", encoding="utf-8")
    (folder / "Customer_List.csv").write_text("Customer_Trx_ID;Customer_Country\nc1;VN\n", encoding="utf-8")
    (folder / "Order_Items.csv").write_text("Order_ID;Order_Item_ID;Product_ID;Seller_ID;Price;Freight_Value\n"
                                            "o1;1;p1;s1;10.5;1.25\no2;1;p1;s1;4;1\n", encoding="utf-8")
    (folder / "Products.csv").write_text("Product_ID;Product_Category_Name\np1;toys\n", encoding="utf-8")
    (folder / "Order_Reviews.csv").write_text("Order_ID;Review_Score\no1;5\no2;abc\n", encoding="utf-8")
    jobs.main(["commerce", str(folder), "10", str(tmp_path / "q10")])
    assert read_parts(tmp_path / "q10" / "seller_ranking") == ["seller_id;total_revenue;total_orders", "s1;16.75;2"]
    jobs.main(["commerce", str(folder), "4", str(tmp_path / "q4")])
    assert read_parts(tmp_path / "q4" / "orders_by_year_month") == ["year;month;total_orders", "2024;2;1", "2024;1;1"]


def test_default_stop_list(spark, tmp_path):
    from quarry.sources import read_wordlist
    stop = read_wordlist(spark, jobs.DEFAULT_STOPWORDS)
    words = [r.stopword for r in stop.collect()]
    assert len(words) == 131 and "và" in words and "chúng tôi" in words
    (tmp_path / "r.csv").write_text("1;Phòng và giường rất sạch;PRICES;HOTEL;positive\n", encoding="utf-8")
    jobs.clean_words(spark, str(tmp_path / "r.csv"), str(tmp_path / "clean"))
    kept = [ln.split(",")[1] for ln in read_parts(tmp_path / "clean")]
    assert "và" not in kept and "phòng" in kept


def test_commerce_reads_only_used_tables(spark, tmp_path):
    folder = tmp_path / "shop"
    folder.mkdir()
    (folder / "Order_Items.csv").write_text("Order_ID;Order_Item_ID;Product_ID;Seller_ID;Price;Freight_Value\n"
                                            "o1;1;p1;s1;10.5;1.25\n", encoding="utf-8")
    # no other file exists: question 10 must not touch them
    got = jobs.commerce_question(spark, str(folder), 10)["seller_ranking"].collect()
    assert [tuple(r) for r in got] == [("s1", 11.75, 1)]


def test_all_commerce_questions(spark, tmp_path):
    folder = tmp_path / "shop"
    folder.mkdir()
    (folder / "Orders.csv").write_text(
        "Order_ID;Customer_Trx_ID;Order_Purchase_Timestamp;Order_Delivered_Carrier_Date\n"
        "o1;c1;2024-01-05 10:00;2024-01-10 09:00\no2;c1;2024-02-10 11:30;\no3;c2;2023-12-31 23:59;2024-01-03 08:00\n",
        encoding="utf-8")
    (folder / "Customer_List.csv").write_text("Customer_Trx_ID;Customer_Country\nc1;VN\nc2;US\n", encoding="utf-8")
    (folder / "Order_Items.csv").write_text(
        "Order_ID;Order_Item_ID;Product_ID;Seller_ID;Price;Freight_Value;Shipping_Limit_Date\n"
        "o1;1;p1;s1;100.0;10.0;2024-01-10 08:00\no2;1;p2;s2;50.5;5.25;2024-02-15 00:00\n"
        "o3;1;p1;s1;10.0;1.0;2024-01-05 00:00\n", encoding="utf-8")
    (folder / "Products.csv").write_text("Product_ID;Product_Category_Name\np1;toys\np2;books\n", encoding="utf-8")
    (folder / "Order_Reviews.csv").write_text("Order_ID;Review_Score\no1;5\no1;4\no3;abc\n", encoding="utf-8")
    got = {}
    for q in range(1, 11):
        for name, df in jobs.commerce_question(spark, str(folder), q).items():
            got[name] = [tuple(r) for r in df.collect()]
    assert got["totals"] == [(3, 2, 2)]
    assert got["orders_by_country"] == [("VN", 2), ("US", 1)]
    assert got["orders_by_year_month"] == [(2023, 12, 1), (2024, 2, 1), (2024, 1, 1)]
    assert got["review_average"] == [(4.5,)] and got["review_distribution"] == [(4, 1), (5, 1)]
    assert got["revenue_by_category"] == [("toys", 110.0), ("books", 55.75)]
    assert got["category_sales_and_score"] == [("toys", 3, 4.5), ("books", 1, None)]
    assert {(r[0], r[1], r[4], r[5]) for r in got["delivery_performance"]} == {
        ("o1", "p1", 0, "On Time / Early"), ("o3", "p1", -2, "On Time / Early")}
    assert sorted(r[0] for r in got["customer_segments"]) == ["c1", "c2"]
    assert got["seller_ranking"] == [("s1", 121.0, 2), ("s2", 55.75, 1)]
    assert {r[0] for r in got["schemas"]} == {"Customer_List", "Order_Items", "Order_Reviews", "Orders", "Products"}


import pytest  # noqa: E402
from collections import Counter  # noqa: E402

JAVA_JOBS = [("title-stats", ["movies"], "expected_title_stats.txt"),
             ("genre-stats", ["movies"], "expected_genre_stats.txt"),
             ("gender-stats", ["users", "movies"], "expected_gender_stats.txt"),
             ("age-stats", ["users", "movies"], "expected_age_stats.txt")]
PY_JOBS = [("item-report", ["movies"], 1, False), ("genre-report", ["movies"], 2, False),
           ("gender-report", ["users", "movies"], 3, True), ("age-report", ["users", "movies"], 4, True),
           ("occupation-report", ["users", "occupation"], 5, False), ("year-report", [], 6, True)]


@pytest.mark.parametrize("job,inputs,expected", JAVA_JOBS)
def test_every_key_value_job(spark, tmp_path, job, inputs, expected):
    args = [f"{J}/ratings_1.txt,{J}/ratings_2.txt"] + [f"{J}/{x}.txt" for x in inputs] + [str(tmp_path / "o")]
    jobs.main([job, *args])
    assert read_parts(tmp_path / "o") == (J / expected).read_text(encoding="utf-8").splitlines()


@pytest.mark.parametrize("job,inputs,n,ordered", PY_JOBS)
def test_every_report_job(spark, tmp_path, job, inputs, n, ordered):
    args = [f"{P}/ratings_1.txt,{P}/ratings_2.txt"] + [f"{P}/{x}.txt" for x in inputs] + [str(tmp_path / "o")]
    jobs.main([job, *args])
    got = read_parts(tmp_path / "o")
    exp = (P / f"expected_report_{n}.txt").read_text(encoding="utf-8").splitlines()
    assert (got == exp) if ordered else (Counter(got) == Counter(exp) and got[0] == exp[0])


def test_top_words_job(spark, tmp_path):
    from test_reviews import ROWS, STOP
    (tmp_path / "r.csv").write_text(ROWS, encoding="utf-8")
    (tmp_path / "s.txt").write_text(STOP, encoding="utf-8")
    jobs.top_words(spark, str(tmp_path / "r.csv"), str(tmp_path / "top"), stopwords=str(tmp_path / "s.txt"))
    lines = read_parts(tmp_path / "top")
    assert any(ln.startswith("PRICES,{(PRICES,phòng,2),(PRICES,tốt,2),") for ln in lines)
