"""The streaming statistics equal the batch ones on the same files, and keep
equal as more files arrive (state restored from the checkpoint)."""

import shutil

from conftest import FIXTURES
from quarry.plans import ratings as R
from quarry.sources import JAVA, read_movies, read_ratings
from quarry.streaming import rating_lines_stream, running_item_stats, start_snapshots

D = FIXTURES / "ratings_java"


def rows(df):
    return sorted((r.title, round(r.avg_rating, 9), r.n_ratings) for r in df.collect())


def test_running_item_stats_matches_batch(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    out = str(tmp_path / "snapshot")
    movies = read_movies(spark, str(D / "movies.txt"), JAVA)
    shutil.copy(D / "ratings_1.txt", inbox / "a.txt")

    def run():
        q = start_snapshots(running_item_stats(rating_lines_stream(spark, str(inbox)), movies), out,
                            name="item_stats_test")
        q.awaitTermination()
        return spark.read.parquet(out)

    first = run()
    assert rows(first) == rows(R.item_rating_stats(read_ratings(spark, str(D / "ratings_1.txt")), movies))
    shutil.copy(D / "ratings_2.txt", inbox / "b.txt")
    second = run()
    both = [str(D / "ratings_1.txt"), str(D / "ratings_2.txt")]
    assert rows(second) == rows(R.item_rating_stats(read_ratings(spark, both), movies))


def test_running_word_counts_match_batch(spark, tmp_path):
    from quarry.plans import reviews as V
    from quarry.sources import read_delimited, read_wordlist
    from quarry.streaming import review_lines_stream, running_word_counts
    from test_reviews import ROWS, STOP
    inbox = tmp_path / "reviews"
    inbox.mkdir()
    lines = ROWS.splitlines(keepends=True)
    (inbox / "a.csv").write_text("".join(lines[:4]), encoding="utf-8")
    (tmp_path / "stop.txt").write_text(STOP, encoding="utf-8")
    stop = read_wordlist(spark, str(tmp_path / "stop.txt"))
    out = str(tmp_path / "counts")

    def run():
        q = start_snapshots(running_word_counts(review_lines_stream(spark, str(inbox)), stop, threshold=1), out,
                            name="word_counts_test")
        q.awaitTermination()
        return {r.word: r.word_count for r in spark.read.parquet(out).collect()}

    def batch():
        return {r.word: r.word_count for r in
                V.frequent_words(V.clean_tokens(read_delimited(spark, str(inbox)), stop), threshold=1).collect()}

    assert run() == batch()
    (inbox / "b.csv").write_text("".join(lines[4:]), encoding="utf-8")
    assert run() == batch() == {"phòng": 3, "nhân": 2, "viên": 2, "thân": 2, "thiện": 2}
