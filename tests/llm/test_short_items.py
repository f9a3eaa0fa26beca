"""Items shorter than the overlap, with every choice of changed tokens."""

from itertools import combinations

import pytest
from test_text_operators import plain_contaminated

from demandgrid.llm import decontaminate


@pytest.mark.parametrize("n", range(5, 14))
def test_short_items_equal_brute_force(spark, n):
    words = [f"w{k}" for k in range(n)]
    texts = []
    for changed in range(4):
        for lost in combinations(range(n), changed):
            own = ["x" if k in lost else w for k, w in enumerate(words)]
            texts.append(" ".join(["a", "b", *own, "c"]))
    docs, items = list(enumerate(texts)), [(7, " ".join(words))]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(d, b).collect()}
    assert got == plain_contaminated(docs, items)
