"""The reference's jobs end to end on reference-style input files."""

from tessera.plans.jobs import run_commerce_jobs, run_rating_jobs, run_report_jobs, run_review_jobs


def _read(path):
    import glob

    lines = []
    for p in sorted(glob.glob(f"{path}/part-*")):
        with open(p, encoding="utf-8") as f:
            lines += f.read().splitlines()
    return lines


def test_rating_jobs(spark, tmp_path):
    (tmp_path / "movies.txt").write_text("1,Toy Story (1995),Animation|Comedy\n2,Heat (1995),Action|Crime\n")
    (tmp_path / "r1.txt").write_text("1,1,4.0,0\n2,1,4.5,0\n")
    (tmp_path / "r2.txt").write_text("1,2,3.0,0\n")
    (tmp_path / "users.txt").write_text("1,M,25,1\n2,F,40,2\n")
    out = run_rating_jobs(spark, str(tmp_path / "movies.txt"), [str(tmp_path / "r1.txt"), str(tmp_path / "r2.txt")],
                          str(tmp_path / "users.txt"), str(tmp_path / "out"), min_support=2)
    # In the order of movie ids, as the reference's output.
    assert _read(out["movie_avg_rating"]) == [
        "Toy Story (1995)\tAverageRating: 4.25 (TotalRatings: 2)",
        "Heat (1995)\tAverageRating: 3.00 (TotalRatings: 1)"]
    assert _read(out["gender_avg_pivot"]) == [
        "Toy Story (1995):\tMale_Avg: 4.00, Female_Avg: 4.50",
        "Heat (1995):\tMale_Avg: 3.00, Female_Avg: N/A"]
    assert _read(out["best_movie"]) == [
        "RESULT:\tToy Story (1995) is the highest rated movie with an average rating of 4.25 "
        "among movies with at least 2 ratings."]
    assert _read(out["rating_count"]) == ["1\t2", "2\t1"]
    assert _read(out["age_avg_pivot"])[1] == "Heat (1995):\t[0-18: N/A, 18-35: 3.00, 35-50: N/A, 50+: N/A]"


def test_the_last_line_of_a_lookup_counts(spark, tmp_path):
    (tmp_path / "movies.txt").write_text("1,Old,A|B\n2,Two,C\n1,New,|A||B||\n")
    (tmp_path / "r.txt").write_text("head\n1,1,4.0,0\n2,1,5.0,0\n")
    (tmp_path / "users.txt").write_text("1,F,25,1\nhead\n1,M,25,1\n2,M,40,2\n")
    paths = [str(tmp_path / f) for f in ("movies.txt", "users.txt")]
    out = run_rating_jobs(spark, paths[0], [str(tmp_path / "r.txt")], paths[1], str(tmp_path / "out"), ratings_header="head", users_header="head")
    assert _read(out["movie_avg_rating"]) == ["New\tAverageRating: 4.50 (TotalRatings: 2)"]
    assert _read(out["gender_avg_pivot"]) == ["New:\tMale_Avg: 4.50, Female_Avg: N/A"]
    # Java's split keeps empty values but the trailing ones.
    assert _read(out["genre_avg_rating"]) == [f"{g}:\t4.50 (TotalRatings: {n})" for g, n in (("", 4), ("A", 2), ("B", 2))]


def test_report_jobs(spark, tmp_path):
    (tmp_path / "movies.txt").write_text("id,title,genres\n1,Toy Story (1995),Animation|Comedy\n2,Heat (1995),Action\n")
    (tmp_path / "r.txt").write_text("u,m,r,t\n1,1,4.0,1609459199\n2,1,4.25,1609459200\n1,2,3.0,1609459200\n")
    (tmp_path / "users.txt").write_text("u,g,a,o\n1,M,17,1\n2,F,40,9\n")
    (tmp_path / "occupation.txt").write_text("1,Student\n")
    paths = {n: str(tmp_path / f"{n}.txt") for n in ("movies", "users", "occupation")}
    out = run_report_jobs(
        spark, paths["movies"], [str(tmp_path / "r.txt")], paths["users"], paths["occupation"], str(tmp_path / "out"),
        "id,title,genres", "u,m,r,t", "u,g,a,o", min_support=2)
    assert _read(out["best_movie"]) == ["ID Phim: 1", "Ten Phim: Toy Story (1995)", "Diem TB: 4.13", "Luot danh gia: 2"]
    assert _read(out["genre"]) == [f"{g:<20} | {m}" for g, m in (("Animation", "4.13"), ("Comedy", "4.13"), ("Action", "3.00"))]
    assert _read(out["gender"])[2] == f"{'Heat (1995)':<40} | {'Nam (M)':<10} | 3.00"
    assert _read(out["age"])[0] == f"{'Toy Story (1995)':<40} | {'35-44':<12} | 4.25"
    assert _read(out["occupation"]) == [f"{'Student':<25} | {'3.50':<12} | 2", f"{'Unknown (9)':<25} | {'4.25':<12} | 1"]
    assert _read(out["year"]) == [f"{'2020':<10} | {'4.00':<10} | 1", f"{'2021':<10} | {'3.63':<10} | 2"]


def test_review_jobs(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text(
        "1;Phòng sạch, phòng đẹp;CLEANLINESS;HOTEL;positive\n2;Ăn sáng dở;FOOD;FOOD;negative\n3;ok;SERVICE\n",
        encoding="utf-8")
    out = run_review_jobs(spark, str(tmp_path / "reviews.csv"), ["và"], str(tmp_path / "out"), threshold=1)
    assert _read(out["aspect_category_counts"]) == [
        "ASPECT: CLEANLINESS\t1", "ASPECT: FOOD\t1", "CATEGORY: FOOD\t1", "CATEGORY: HOTEL\t1"]
    assert _read(out["aspect_sentiment"]) == ["CLEANLINESS\tPositive: 1, Negative: 0",
                                              "FOOD\tPositive: 0, Negative: 1"]
    assert _read(out["word_frequency"]) == ["phòng\t2"]
    assert _read(out["category_sentiment_top_words"])[1] == "HOTEL:positive\tphòng(2) sạch(1) đẹp(1)"
    assert _read(out["clean_text"]) == ["1\tphòng sạch phòng đẹp", "2\tăn sáng dở", "3\tok"]


def test_commerce_jobs(spark, tmp_path):
    (tmp_path / "Customer_List.csv").write_text("Customer_Trx_ID;Subscriber_ID;Customer_Country\nc1;s1;VN\n")
    (tmp_path / "Orders.csv").write_text(
        "Order_ID;Customer_Trx_ID;Order_Purchase_Timestamp;Order_Delivered_Carrier_Date\n"
        "o1;c1;2024-03-01 10:00:00;2024-03-03 09:00:00\n")
    (tmp_path / "Order_Items.csv").write_text(
        "Order_ID;Order_Item_ID;Product_ID;Seller_ID;Price;Freight_Value;Shipping_Limit_Date\n"
        "o1;1;p1;s9;10.5;1.25;2024-03-02 00:00:00\n")
    (tmp_path / "Order_Reviews.csv").write_text("Review_ID;Order_ID;Review_Score\nr1;o1;5\n")
    (tmp_path / "Products.csv").write_text("Product_ID;Product_Category_Name\np1;toys\n")
    out = run_commerce_jobs(spark, str(tmp_path), str(tmp_path / "out"), 2024)
    assert len(out) == 9
    rev = spark.read.csv(out["revenue_by_category"], header=True).collect()
    assert [tuple(r) for r in rev] == [("toys", "11.75")]
