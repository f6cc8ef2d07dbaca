"""Documents with every awkward case, and plain versions of what the operators count."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id string, size string, shard string, start string, bucket string, text_key string, score string, kid string")


def words(text):
    return WORD.findall(text or "")


def sentence(draw, n):
    return " ".join("".join(draw.choice("abcdefgé") for _ in range(draw.randint(2, 6))) for _ in range(n))


def awkward_rows(seed=0):
    """Texts with copies, near copies, shared passages, repeats inside, odd white space, nulls and repeated rows."""
    draw = random.Random(seed)
    passage, base = sentence(draw, 60), sentence(draw, 120)
    near = base.split(" ")
    texts = [base, base, base + " more", " ".join([*near[:50], "changed", *near[51:]])]
    texts += [f"{sentence(draw, 20)} {passage} {sentence(draw, 15)}" for _ in range(3)]
    texts += [f"{passage}\n{passage}", sentence(draw, 4000), "one two three", "one two three", "", None, None, " \t\n",
              "a b c d", "x\x0by\x0cz\r\nw", "line\nline\nline\nother", "w " * 50, "Ä éé \U0001f600 #$ <b>"]
    rows = [(n, text) for n, text in enumerate(texts)]
    rows += [(None, base), (None, None), (3, texts[3]), (3, texts[3]), (4, "other text under the id of another row")]
    sources = ["a", "b", None, "ä", "Z"]
    return [(n, text, "en", sources[place % 5], None, *["clash"] * 8) for place, (n, text) in enumerate(rows)]


def documents(spark, rows=None):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, SCHEMA)


def plain(spark, pairs):
    """Documents from (doc_id, text) alone."""
    return spark.createDataFrame([(n, text, "en", "s", None) for n, text in pairs],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def collected(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
