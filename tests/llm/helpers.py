"""Small tables and brute-force forms for the corpus operators."""
import random

WORDS = ("alpha beta gamma delta river stone cloud meadow lantern harbour window candle orchard winter silver "
         "copper garden market bridge forest island valley thunder whisper compass anchor voyage harvest").split()


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 99)) for _ in range(n))


def docs_frame(spark, rows):
    """documents from (doc_id, text) with the usual columns and clashing extra ones."""
    return spark.createDataFrame(
        [(i, t, "en", "src", None if t is None else len(t), 7, "x", 1.5) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, n_words int, score string, fp double")


#: nulls, empty and blank texts, a repeated row, a tie of copies, a null id, a very long text
EDGE = [(1, None), (2, ""), (3, " \t\n "), (4, prose(4, 80)), (4, prose(4, 80)), (5, prose(4, 80)),
        (None, prose(6, 60)), (7, prose(7, 6000)), (8, "word"), (9, "Ünïcödé 漢字 😀\x00\x1f end")]
