from __future__ import annotations

import pytest
#: Columns whose names clash with those that the operators use.
CLASH = ("score", "size", "block", "key", "toxic_score", "_key", "blob", "ids", "place")
DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    + ", ".join(f"{c} string" for c in CLASH))
LONG = " ".join(f"word{i % 977} token={'ab12' * 8}" for i in range(4000))
#: Nulls in every column, empty and very long texts, ties and repeated rows.
EDGE = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t", None, "a", 3),
    (4, "One two three.", "en", "b", 14), (5, LONG, "en", "a", len(LONG)),
    (6, "You are an idiot, a worthless idiot!", "en", "b", 36),
    (7, "Released under the MIT License. password = hunter2secret", "en", None, 55),
    (7, "Released under the MIT License. password = hunter2secret", "en", None, 55),
    (8, "One two three.", "de", "b", 14), (None, "no id here at all, just words", "en", "c", 29),
    (None, None, None, None, None), (9, "Ünï çödé 'S x'LL <|endoftext|> 12 ﬁ", "fr", "c", 30),
]


def write(spark, rows, folder, name, schema):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def folder_of(spark, folder, docs, labels=(), vectors=(), turns=()):
    write(spark, [(*r, *CLASH) for r in docs], folder, "documents", DOCS)
    write(spark, list(labels), folder, "labels", "doc_id long, quality int, toxic int, text string")
    write(spark, list(vectors), folder, "embeddings",
          "vec_id long, embedding array<float>, label int, v string, score string")
    write(spark, list(turns), folder, "conversations",
          "conv_id long, turn long, role string, text string, rows string")
    return folder


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    return folder_of(
        spark, str(tmp_path_factory.mktemp("edge")), EDGE,
        [(6, 1, 1, "x"), (4, None, 0, None), (None, 1, 1, None), (8, 0, None, None), (4, 1, 0, None)],
        [(0, [1.0, 0.5], 1, "", ""), (20, [0.5, 0.25], 1, "", ""), (100, None, 1, "", ""),
         (50, [0.0, 0.0], 1, "", ""), (3, [float("nan"), 1.0], 1, "", ""), (None, [1.0, 1.0], 1, "", ""),
         (4, [None, 1.0], None, None, None), (5, [], 1, "", ""), (6, [0.5, 0.25], 1, "", ""),
         (7, [1.0, 2.0, 3.0], 1, "", ""), (60, [1.0, 1.0, 1.0], 1, "", ""),
         (8, [float("inf"), 1.0], 1, "", ""), (6, [0.5, 0.25], 1, "", "")],
        [(1, 0, "user", "hi", ""), (1, 1, "assistant", "hello <|im_end|>", ""), (1, 2, "user", "more", ""),
         (1, 3, "assistant", "again", ""), (1, 4, "user", "left over", ""),
         (2, 0, "user", "only a question", ""), (3, 0, "assistant", None, ""),
         (4, None, None, None, None), (4, 0, "assistant", "a", ""), (4, 1, "assistant", "a", ""),
         (None, 0, "assistant", "lost", ""), (5, 0, "user", "x", ""), (5, 0, "user", "x", ""),
         (5, 1, "assistant", "y", "")])


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    return folder_of(spark, str(tmp_path_factory.mktemp("empty")), [])
