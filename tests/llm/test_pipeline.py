import itertools
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from quarry.llm import decontaminate, mixing, ppm, queries, simhash
from quarry.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stages_are_the_five_in_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "decontamination", "mix", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_equals_the_stages_in_plain_python(spark):
    """Decisions of the small operators, checked on their own elsewhere, applied row by row in Python."""
    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    frame = lambda rows: spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    model = ppm.learn(frame(docs))
    judged = {r.doc_id: r for r in ppm.identify(frame(docs), model).collect()}
    docs = [d for d in docs if judged[d["doc_id"]].lang_pred != "und" and judged[d["doc_id"]].bits_per_byte < 8]
    low = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame(docs)).collect()}
    docs = [d for d in docs if low[d["doc_id"]] == d["doc_id"]]
    automaton = decontaminate.Automaton([(str(i), decontaminate.alnum_words(t)) for i, t in enumerate(bench)], 10)
    docs = [d for d in docs if not automaton.find(decontaminate.alnum_words(d["text"]))[0]]
    turns = sorted((r.slot, r.place, r.doc_id) for r in mixing.schedule(frame(docs)).collect())
    tokenizer, text = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER)), {d["doc_id"]: d["text"] for d in docs}
    want, start = [], 0
    for *_, i in turns:
        ids = tokenizer.encode(text[i], add_special_tokens=False).ids + [queries.END_ID]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want) and len(got) > 100
    # the shards are in the order of the turns: sources alternate
    order = [i for i, *_ in sorted(got, key=lambda r: r[1])]
    assert order == [i for *_, i in turns] != sorted(order)
    source = {d["doc_id"]: d["source"] for d in docs}
    runs = [len(list(g)) for _, g in itertools.groupby(order, source.get)]
    assert max(runs) <= 2 * mixing.BLOCK_DOCS and len(set(source.values())) > 10


def test_stages_keep_columns_and_meet_odd_rows(spark, odd_documents, no_documents):
    for start in (odd_documents, no_documents):
        docs = stored(start, "odd")
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, docs, SF), name)
            if name != "tokens":
                assert out.columns == odd_documents.columns
            docs = out
        ids = {r.doc_id for r in docs.collect()}
        # 5 is a copy of 4, and 7 of 6; 8 has no letters, 1 to 3 no words
        assert ids <= {4, 6, 9, None} and (start is no_documents or {4, 6, 9} <= ids)
