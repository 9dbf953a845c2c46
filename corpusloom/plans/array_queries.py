"""Queries on token arrays, packs and orders, compared value for value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import arrays, tokenizers
from corpusloom.operators import blending, knapsack, ordinals
from corpusloom.plans.digests import listed, sql_listed
from corpusloom.session import table, wide_table
from corpusloom.streaming import streams

EOS, ASSISTANT, PAD, LENGTH = 257, 261, 258, 2048
_NONE = "array<int>"


def _tokens(spark: SparkSession, root: str) -> DataFrame:
    """Tokens and labels of every sample, none where they are null."""
    return wide_table(spark, root, "sft_tokens").select("sample_id", F.coalesce("input_ids", F.array().cast(_NONE)).alias("x"), F.coalesce("labels", F.array().cast(_NONE)).alias("y"))


def _lists(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select("sample_id", *[listed(c).alias(n) for n, c in columns.items()])


def arr_positions(spark: SparkSession, root: str) -> DataFrame:
    """WIN-04: positions and segments that begin anew behind end tokens."""
    return _lists(_tokens(spark, root), positions=arrays.positions_after_end(F.col("x"), EOS), segments=arrays.segments(F.col("x"), EOS))


def arr_spans(spark: SparkSession, root: str) -> DataFrame:
    """WIN-16, ARR-04: labels from the k-th opening mark to the k-th end."""
    return _lists(_tokens(spark, root), labels=arrays.span_labels(F.col("x"), ASSISTANT, EOS))


def arr_runs(spark: SparkSession, root: str) -> DataFrame:
    """WIN-10: where the runs of -100 begin and end."""
    d = _tokens(spark, root).withColumn("r", arrays.prompt_runs(F.col("y")))
    return _lists(d, begins=F.filter("r.begin", lambda x: x.isNotNull()), ends=F.filter("r.end", lambda x: x.isNotNull()))


def arr_shifted(spark: SparkSession, root: str) -> DataFrame:
    """ARR-05, ARR-06: inputs, next tokens, loss mask and tokens without padding."""
    inputs, nexts = arrays.shifted(F.col("x"))
    return _lists(_tokens(spark, root), inputs=inputs, nexts=nexts, mask=arrays.loss_mask(nexts, EOS, PAD), bare=arrays.zero_padding(F.col("x"), PAD))


def arr_filled(spark: SparkSession, root: str) -> DataFrame:
    """ARR-01, ARR-02, ARR-07: filled to a multiple, ended, and filled to a length."""
    x = F.col("x")
    return _lists(_tokens(spark, root), multiple=arrays.pad_to_multiple(x, 64, PAD, True), ended=arrays.append_end(x, EOS), filled=arrays.filled_to(x, LENGTH + 1, PAD))


def arr_masked(spark: SparkSession, root: str) -> DataFrame:
    """ARR-03: labels of a prompt and an answer."""
    x = F.col("x")
    half = F.floor(F.size("x") / 2).cast("int")
    return _lists(_tokens(spark, root), labels=arrays.masked(F.slice(x, F.lit(1), half), F.slice(x, half + 1, F.size("x"))))


def arr_ends(spark: SparkSession, root: str) -> DataFrame:
    """WIN-05 to WIN-08, ARR-13: segment ends from end tokens and from positions, moved for later predictions, and cut at the tail."""
    x = F.col("x")
    ends = arrays.sequence_ends(x, EOS)
    tail = F.concat(ends, F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.size("x") + i))
    return _lists(_tokens(spark, root), ends=ends, zeros=arrays.ends_from_positions(arrays.positions_after_end(x, EOS)), moved=arrays.shifted_ends(ends, 2, 16), trimmed=arrays.trimmed_tail(tail, 2))


def arr_load(spark: SparkSession, root: str) -> DataFrame:
    """AGG-19: load of attention of each sample."""
    return _tokens(spark, root).select("sample_id", F.round(arrays.attention_load(arrays.sequence_ends(F.col("x"), EOS), LENGTH), 9).alias("load"))


def arr_packed_positions(spark: SparkSession, root: str) -> DataFrame:
    """WIN-09: positions of segments numbered from 1, none over the padding."""
    segments = arrays.segments(F.col("x"), EOS)
    d = _tokens(spark, root).withColumn("m", F.concat(F.transform(segments, lambda s: s + 1), F.array_repeat(F.lit(0), (F.col("sample_id") % 4).cast("int"))))
    return _lists(d, positions=arrays.packed_positions(F.col("m")))


def arr_regenerated(spark: SparkSession, root: str) -> DataFrame:
    """WIN-15: positions before the first zero counted anew, others less by an offset."""
    at = arrays.positions_after_end(F.col("x"), EOS)
    return _lists(_tokens(spark, root).withColumn("p", F.when(F.col("sample_id") % 2 == 0, F.slice(at, 6, F.size(at))).otherwise(F.transform(at, lambda v: v + 7))), positions=arrays.regenerated_positions(F.col("p"), 5))


def arr_attends(spark: SparkSession, root: str) -> DataFrame:
    """ARR-08, ARR-12: how many keys each tenth position of a sample may see."""
    d = _tokens(spark, root).withColumn("m", F.transform(arrays.segments(F.col("x"), EOS), lambda s: s + 1)).withColumn("q", F.filter(F.sequence(F.lit(0), F.size("x")), lambda i: (i % 50 == 0) & (i < F.size("x"))))
    near = lambda q: F.filter(F.sequence(F.greatest(q - 60, F.lit(0)), F.least(q + 60, F.size("x") - 1)), lambda k: arrays.may_attend(F.col("m"), q, k))
    return _lists(d, seen=F.transform("q", lambda q: F.size(near(q))))


def arr_context(spark: SparkSession, root: str) -> DataFrame:
    """ARR-10, SRC-25: a rank's share of a sequence, and a part of it."""
    return _lists(_tokens(spark, root), share=arrays.context_chunk(F.col("x"), 1, 4), part=F.slice("x", 4, 10))


def arr_cut_pairs(spark: SparkSession, root: str) -> DataFrame:
    """PCK-06, PCK-09: chosen and rejected samples cut together, the chosen ones first."""
    d = _tokens(spark, root).where("size(x) = size(y)").select("sample_id", F.col("x").alias("chosen_input_ids"), F.col("y").alias("chosen_labels"), F.concat("x", F.array(F.lit(1), F.lit(2))).alias("rejected_input_ids"), F.concat("y", F.array(F.lit(1), F.lit(2))).alias("rejected_labels"))
    return knapsack.pairwise_rows(knapsack.cut_pairwise(d, 512), "sample_id").select("side", "sample_id", listed(F.col("input_ids")).alias("ids"), listed(F.col("labels")).alias("labels"))


def arr_plain_cut(spark: SparkSession, root: str) -> DataFrame:
    """PCK-07, FIL-07: the first tokens."""
    return _lists(_tokens(spark, root), cut=knapsack.plain_cut(F.col("x"), 100))


def pack_totals(spark: SparkSession, root: str) -> DataFrame:
    """PCK-02, PCK-03, JOI-11, SNK-07, AGG-15, HDL-18: every token of the samples that fit lies in one pack, none twice; packs are full rows."""
    own = _tokens(spark, root).select("sample_id", F.col("x").alias("input_ids"), F.slice(F.concat("y", F.array_repeat(F.lit(-100), F.greatest(F.size("x") - F.size("y"), F.lit(0)))), F.lit(1), F.size("x")).alias("labels"))
    packs = knapsack.packed(own, "sample_id", LENGTH, PAD)
    total = lambda c: F.sum(F.aggregate(c, F.lit(0).cast("bigint"), lambda a, v: a + v))
    bare = F.slice("input_ids", F.lit(1), F.col("n_tokens"))
    return packs.agg(F.sum("n_samples").alias("samples"), F.sum("n_tokens").cast("bigint").alias("tokens"), total(bare).alias("id_sum"), total(F.slice("labels", F.lit(1), F.col("n_tokens"))).alias("label_sum"), F.min(F.size("input_ids")).alias("shortest"), F.max(F.size("labels")).alias("longest"))


def collated_batches(spark: SparkSession, root: str) -> DataFrame:
    """BAT-04: rows of a batch filled to its longest, rounded up."""
    d = wide_table(spark, root, "sft_tokens").select("sample_id", "input_ids", "labels", F.floor(F.col("sample_id") / 4).alias("batch"))
    made = ordinals.collated(d, "batch", "input_ids", "labels", 64, PAD)
    return made.select("sample_id", listed(F.col("input_ids")).alias("ids"), listed(F.col("labels")).alias("labels"), listed(F.col("attention_mask")).alias("mask"))


# orders


def _ids(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id")


def loader_single(spark: SparkSession, root: str) -> DataFrame:
    """BAT-01, BAT-03, STM-05: what is left to read in order, dealt out to ranks."""
    return ordinals.loader_order(_ids(spark, root), "doc_id", "single", 4, 8, consumed=100)


def loader_cyclic(spark: SparkSession, root: str) -> DataFrame:
    """BAT-03, SHF-05: each rank's bucket, shuffled by epoch."""
    return ordinals.loader_order(_ids(spark, root), "doc_id", "cyclic", 2, 4, consumed=16, seed=9)


def rank_domains(spark: SparkSession, root: str) -> DataFrame:
    """BAT-05: which ranks read the same part, for a few machines."""
    rows = [(w, t, p, k, r) for w, t, p in ((8, 2, 2), (16, 4, 1), (16, 2, 4)) for k, ranks in enumerate(ordinals.rank_domains(w, t, p)) for r in ranks]
    return spark.createDataFrame(rows, "world int, tensor int, pipeline int, part int, rank int")


def ranks_in_turn(spark: SparkSession, root: str) -> DataFrame:
    """BAT-02."""
    return ordinals.with_prefix(_ids(spark, root), ["doc_id"]).select("doc_id", ordinals.rank_of(F.col("ord"), 6).alias("rank"))


def sample_provenance(spark: SparkSession, root: str) -> DataFrame:
    """ARR-11, JOI-09: the documents of which a sample has tokens."""
    docs = table(spark, root, "documents").select("doc_id", F.octet_length("text").alias("n"))
    return ordinals.sample_documents(docs, ["doc_id"], F.coalesce("n", F.lit(0)), 64 * 1024).select("sample", listed(F.col("document_ids")).alias("document_ids"), listed(F.col("idx")).alias("idx"))


def epochs_planned(spark: SparkSession, root: str) -> DataFrame:
    """AGG-12, SHF-02: tokens, the epochs that samples need and whether the last one is shuffled apart."""
    total = table(spark, root, "documents").agg(F.sum(F.octet_length("text"))).first()[0]
    rows = []
    for n in (1, 100, 1000, 123_456):
        per = ordinals.samples_in(total, LENGTH)
        rows.append((n, total, ordinals.epochs_needed(total, LENGTH, n), ordinals.separate_final_epoch(n, per)))
    return spark.createDataFrame(rows, "samples bigint, tokens bigint, epochs bigint, apart boolean")


def validation_split(spark: SparkSession, root: str) -> DataFrame:
    """SPL-04, SPL-08: a seeded share for validation."""
    train, held = ordinals.train_validation(_ids(spark, root), "doc_id", 0.1, 3)
    module = ordinals.data_module({"train": train, "validation": held})
    return module["train_dataset"].withColumn("held", F.lit(False)).unionByName(module["eval_dataset"].withColumn("held", F.lit(True)))


def stream_split(spark: SparkSession, root: str) -> DataFrame:
    """SPL-04, STM-02: the first rows of a shuffled stream for validation, the rest for training."""
    first, rest = streams.take_skip(ordinals.shuffled(_ids(spark, root), "doc_id", 8), "pos", 50)
    return first.withColumn("held", F.lit(True)).unionByName(rest.withColumn("held", F.lit(False)))


def stream_resumed(spark: SparkSession, root: str) -> DataFrame:
    """STM-04, STM-05: what is left behind a position."""
    return streams.from_position(ordinals.with_prefix(_ids(spark, root), ["doc_id"]), "ord", 123)


def sub_ranges(spark: SparkSession, root: str) -> DataFrame:
    """SPL-05, SNK-09: full gaps and the remainder."""
    n = _ids(spark, root).count()
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(ordinals.sub_ranges(n, 64))], "part int, first bigint, last bigint")


def padded_parts(spark: SparkSession, root: str) -> DataFrame:
    """SPL-06, SPL-07: even parts, the short ones with the first row once more."""
    placed = ordinals.with_prefix(_ids(spark, root), ["doc_id"])
    return ordinals.padded_parts(placed, "ord", placed.count(), 7).select("doc_id", "part", "padding")


def split_intersection(spark: SparkSession, root: str) -> DataFrame:
    """SPL-01, SPL-02, SPL-03, SPL-09: what two splits have in common, as ranges of ordinals."""
    n = _ids(spark, root).count()
    both = ordinals.common_bounds(ordinals.split_bounds(ordinals.split_weights("80,15,5")), ordinals.split_bounds(ordinals.split_weights("90,10")))
    rows = [(name, None if b is None else round(b[0] * n), None if b is None else round(b[1] * n)) for name, b in zip(("train", "valid", "test"), both, strict=True)]
    return spark.createDataFrame(rows, "split string, first bigint, last bigint")


def resampled_rows(spark: SparkSession, root: str) -> DataFrame:
    """SMP-03, SRC-06: all rows once and as many drawn again as are missing."""
    docs = _ids(spark, root)
    return ordinals.resampled(docs, "doc_id", 2 * docs.count() + 77, 5)


def bucketed_epoch(spark: SparkSession, root: str) -> DataFrame:
    """SHF-05: an epoch of buckets from its beginning."""
    return ordinals.bucket_order(_ids(spark, root), "doc_id", 0, 2, 4, 9)


def permutations(spark: SparkSession, root: str) -> DataFrame:
    """SHF-01, SHF-04, SHF-06: whole permutations behind one another, each filled up to a multiple."""
    docs = _ids(spark, root)
    return ordinals.repeated_order(docs, "doc_id", 2 * docs.count() + 1, 3, pad_to=64)


def permutations_reshuffled(spark: SparkSession, root: str) -> DataFrame:
    """SHF-04: all repetitions shuffled together once more."""
    docs = _ids(spark, root)
    return ordinals.repeated_order(docs, "doc_id", 2 * docs.count() + 1, 3, reshuffle=True)


def _sizes(spark: SparkSession, root: str) -> list[int]:
    return [r["count"] for r in table(spark, root, "documents").where("lang IS NOT NULL").groupBy("lang").count().orderBy("lang").collect()]


def blend_drawn(spark: SparkSession, root: str) -> DataFrame:
    """SMP-04, SET-02: the documents of all languages interleaved at random until each has been used up."""
    sizes = _sizes(spark, root)
    return blending.interleaved(spark, sizes, [1.0] * len(sizes), seed=3, until="all_exhausted")


def blend_first_exhausted(spark: SparkSession, root: str) -> DataFrame:
    """SMP-04: the same until the first is used up."""
    sizes = _sizes(spark, root)
    return blending.interleaved(spark, sizes, [float(n) for n in sizes], seed=4)


def blend_languages(spark: SparkSession, root: str) -> DataFrame:
    """SET-07, SET-09, JOI-10: all documents of all languages, blended in proportion to their numbers, exactly as often as there are."""
    docs = table(spark, root, "documents").where("lang IS NOT NULL").select("doc_id", "lang")
    names = [r["lang"] for r in docs.select("lang").distinct().orderBy("lang").collect()]
    parts = [ordinals.with_prefix(docs.where(F.col("lang") == c), ["doc_id"]) for c in names]
    sizes = dict(zip(names, _sizes(spark, root), strict=True))
    plan = blending.blends_by_split(spark, blending.Blend(names), {"train": sizes}, {"train": None})["train"]
    return blending.blended_rows(plan, parts).select("pos", "doc_id", "lang")


def blend_by_weight(spark: SparkSession, root: str) -> DataFrame:
    """SET-06, SET-08, AGG-13, AGG-14: a third of the documents drawn by weights, largest deficit first."""
    n = _ids(spark, root).count() // 3
    weights, _ = blending.blend_list(["0.5", "a", "0.3", "b", "0.2", "c"])
    plan = blending.split_blend(spark, blending.Blend(["a", "b", "c"], weights), {"a": n, "b": n, "c": n}, n)
    return plan.groupBy("dataset_id").agg(F.count("*").alias("n"), F.max("sample_id").alias("last"))


def vocabulary_sizes(spark: SparkSession, root: str) -> DataFrame:
    """MTH-03, TOK-01, TOK-02, TOK-05, TOK-07: sizes rounded up, and ids of single tokens of the byte tokenizer."""
    t = tokenizers.ByteTokenizer()
    rows = [(n, tokenizers.padded_vocabulary(n), tokenizers.single_token(t, chr(65 + n % 26))) for n in range(250, 400, 7)]
    return spark.createDataFrame(rows, "size int, padded int, token int")


def texts_decoded(spark: SparkSession, root: str) -> DataFrame:
    """TOK-03, TOK-06: every text encoded by a public byte-pair vocabulary and decoded again."""
    path = spark.conf.get("spark.corpusloom.vocabulary", "/opt/tokenizers/byte_bpe_50k.tiktoken")

    def run(batches):
        import pyarrow as pa

        t = tokenizers.FileTokenizer(path)
        for b in batches:
            out = [None if x is None else t.decode(t.encode(x)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    return wide_table(spark, root, "documents").select("doc_id", "text").mapInArrow(run, "doc_id bigint, text string")


QUERIES = {f.__name__: f for f in (arr_positions, arr_spans, arr_runs, arr_shifted, arr_filled, arr_masked, arr_ends, arr_load, arr_packed_positions, arr_regenerated, arr_attends, arr_context, arr_cut_pairs, arr_plain_cut, pack_totals, collated_batches, loader_single, loader_cyclic, rank_domains, ranks_in_turn, sample_provenance, epochs_planned, validation_split, stream_split, stream_resumed, sub_ranges, padded_parts, split_intersection, resampled_rows, bucketed_epoch, permutations, permutations_reshuffled, blend_drawn, blend_first_exhausted, blend_languages, blend_by_weight, vocabulary_sizes, texts_decoded)}

_T = "WITH t AS (SELECT sample_id, COALESCE(input_ids, []) AS x, COALESCE(labels, []) AS y FROM sft_tokens)"
#: One row a token, with the number of end tokens before it and its position behind the last one.
_EACH = f"{_T}, u AS (SELECT sample_id, x[i] AS v, i - 1 AS i FROM (SELECT sample_id, x, unnest(range(1, len(x) + 1)) AS i FROM t)), g AS (SELECT *, SUM(CASE WHEN v = {EOS} THEN 1 ELSE 0 END) OVER (PARTITION BY sample_id ORDER BY i) - CASE WHEN v = {EOS} THEN 1 ELSE 0 END AS seg FROM u), p AS (SELECT *, row_number() OVER (PARTITION BY sample_id, seg ORDER BY i) - 1 AS pos, COUNT(*) OVER (PARTITION BY sample_id) AS n FROM g)"
_ENDS = f"list_concat(list_filter(range(1, len(x) + 1), lambda i: x[i] = {EOS}), CASE WHEN len(x) > 0 AND x[-1] <> {EOS} THEN [len(x)] ELSE [] END)"
_agg = lambda v, order="i": f"md5(string_agg(CAST({v} AS VARCHAR), ',' ORDER BY {order}))"
_RANDOM = lambda seed, n: f"CAST(('0x' || substr(md5(concat_ws('-', '{seed}', {n})), 1, 12)) AS BIGINT)"


def _drawn(seed: int, weights: str, all_: bool) -> str:
    """The interleaving: every position draws a language, numbered in its own order, up to where it ends."""
    return f"""WITH s AS (SELECT lang, COUNT(*) AS n, row_number() OVER (ORDER BY lang) - 1 AS k FROM documents WHERE lang IS NOT NULL GROUP BY lang),
        w AS (SELECT *, CAST({weights} AS DOUBLE) / SUM({weights}) OVER () AS p FROM s), c AS (SELECT *, SUM(p) OVER (ORDER BY k) AS cut, COUNT(*) OVER () AS many FROM w),
        r AS (SELECT i AS pos, {_RANDOM(seed, "i")} / CAST(281474976710656 AS DOUBLE) AS u FROM (SELECT unnest(range(0, (SELECT CAST(3 * {"MAX" if all_ else "MIN"}(n / p) + 300 AS BIGINT) FROM w))) AS i)),
        d AS (SELECT pos, (SELECT MIN(k) FROM c WHERE u < cut OR k = many - 1) AS k FROM r), e AS (SELECT pos, k, row_number() OVER (PARTITION BY k ORDER BY pos) AS nth FROM d),
        l AS (SELECT {"MAX" if all_ else "MIN"}(pos) AS last FROM e JOIN s USING (k) WHERE nth = n)
        SELECT pos, CAST(k AS SMALLINT) AS dataset_id, (nth - 1) % n AS sample_id FROM e JOIN s USING (k), l WHERE pos <= last"""


_BUCKETS = """WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS o, COUNT(*) OVER () // 8 * 2 AS per FROM documents), r AS (SELECT doc_id, CAST(o // per AS INT) AS rank FROM o WHERE o // per < 4),
        q AS (SELECT doc_id, rank, row_number() OVER (PARTITION BY rank ORDER BY md5(concat_ws('-', '9', doc_id)), doc_id) - 1 AS pos FROM r)"""
_REPEATS = """WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS o, COUNT(*) OVER () AS n FROM documents), w AS (SELECT *, {extra} AS extra FROM o),
        one AS (SELECT doc_id, o, 0 AS c, n, extra FROM w UNION ALL SELECT doc_id, o, 1, n, extra FROM w WHERE o < extra), e AS (SELECT *, unnest(range(0, CAST(ceil((2.0 * n + 1) / (n + extra)) AS BIGINT))) AS e FROM one)
        SELECT row_number() OVER (ORDER BY {order}) - 1 AS pos, doc_id FROM e"""

SQL = {
    "arr_positions": f"{_EACH} SELECT sample_id, COALESCE({_agg('pos')}, md5('')) AS positions, COALESCE({_agg('seg')}, md5('')) AS segments FROM t LEFT JOIN p USING (sample_id) GROUP BY sample_id",
    "arr_spans": f"""{_T}, s AS (SELECT sample_id, x, list_filter(range(1, len(x) + 1), lambda i: x[i] = {ASSISTANT}) AS a, list_filter(range(1, len(x) + 1), lambda i: x[i] = {EOS}) AS b FROM t), z AS (SELECT sample_id, x, list_filter(list_zip(a, b), lambda z: z[1] IS NOT NULL AND z[2] IS NOT NULL) AS z FROM s)
        SELECT sample_id, {sql_listed("list_transform(x, lambda v, i: CASE WHEN len(list_filter(z, lambda s: s[1] <= i AND i <= s[2])) > 0 THEN v ELSE -100 END)")} AS labels FROM z""",
    "arr_runs": f"""{_T} SELECT sample_id, {sql_listed("list_filter(range(0, len(y)), lambda i: y[i + 1] = -100 AND (i = 0 OR y[i] <> -100))")} AS begins, {sql_listed("list_filter(range(1, len(y)), lambda i: y[i + 1] <> -100 AND y[i] = -100)")} AS ends FROM t""",
    "arr_shifted": f"""{_T} SELECT sample_id, {sql_listed("x[1:len(x) - 1]")} AS inputs, {sql_listed("x[2:]")} AS nexts, {sql_listed(f"list_transform(x[2:], lambda v: CASE WHEN v IN ({EOS}, {PAD}) THEN 0 ELSE 1 END)")} AS mask, {sql_listed(f"list_transform(x, lambda v: CASE WHEN v = {PAD} THEN 0 ELSE v END)")} AS bare FROM t""",
    "arr_filled": f"""{_T} SELECT sample_id, {sql_listed(f"list_concat(x, list_transform(range(0, 63 - len(x) % 64), lambda i: {PAD}))")} AS multiple, {sql_listed(f"list_concat(x, [{EOS}])")} AS ended, {sql_listed(f"list_concat(x, list_transform(range(0, GREATEST({LENGTH + 1} - len(x), 0)), lambda i: {PAD}))")} AS filled FROM t""",
    "arr_masked": f"""{_T} SELECT sample_id, {sql_listed("list_transform(x, lambda v, i: CASE WHEN i <= len(x) // 2 THEN -100 ELSE v END)")} AS labels FROM t""",
    "arr_ends": f"""{_T}, e AS (SELECT sample_id, x, {_ENDS} AS e FROM t), f AS (SELECT *, list_concat(e, [len(x) + 1, len(x) + 2, len(x) + 3]) AS f FROM e), h AS (SELECT *, list_filter(range(1, len(f)), lambda i: f[i + 1] - f[i] = 1) AS h FROM f)
        SELECT sample_id, {sql_listed("e")} AS ends, {sql_listed(f"list_concat(list_filter(range(1, len(x)), lambda i: x[i] = {EOS}), [len(x)])")} AS zeros, {sql_listed("list_transform(e, lambda v: CASE WHEN v % 16 = 0 THEN v ELSE v - 2 END)")} AS moved, {sql_listed("CASE WHEN len(h) >= 2 THEN list_concat(f[1:h[2]], [f[-1]]) ELSE f END")} AS trimmed FROM h""",
    "arr_load": f"""{_T}, e AS (SELECT sample_id, {_ENDS} AS e FROM t) SELECT sample_id, round(CAST(0.5 AS DOUBLE) * COALESCE(list_sum(list_transform(e, lambda v, i: (v - CASE WHEN i = 1 THEN 0 ELSE e[i - 1] END) * (v - CASE WHEN i = 1 THEN 0 ELSE e[i - 1] END))), 0) / ({LENGTH} * {LENGTH}), 9) AS load FROM e""",
    "arr_packed_positions": f"""{_EACH}, l AS (SELECT sample_id, list(pos ORDER BY i) AS l FROM p GROUP BY sample_id) SELECT sample_id, {sql_listed("list_concat(COALESCE(l, []), list_transform(range(0, sample_id % 4), lambda i: 0))")} AS positions FROM t LEFT JOIN l USING (sample_id)""",
    "arr_regenerated": f"""{_EACH}, l AS (SELECT sample_id, list(pos ORDER BY i) AS l FROM p GROUP BY sample_id), m AS (SELECT sample_id, CASE WHEN sample_id % 2 = 0 THEN COALESCE(l, [])[6:] ELSE list_transform(COALESCE(l, []), lambda v: v + 7) END AS q FROM t LEFT JOIN l USING (sample_id)), f AS (SELECT *, COALESCE(list_position(q, 0), 0) AS f FROM m)
        SELECT sample_id, {sql_listed("list_transform(q, lambda v, i: CASE WHEN f > 1 AND i < f THEN i - 1 WHEN f = 0 THEN v - 5 ELSE v END)")} AS positions FROM f""",
    "arr_attends": f"""{_EACH} SELECT t.sample_id, COALESCE(md5(string_agg(CAST(LEAST(pos, 60) + 1 AS VARCHAR), ',' ORDER BY i)), md5('')) AS seen FROM t LEFT JOIN (SELECT * FROM p WHERE i % 50 = 0) q USING (sample_id) GROUP BY t.sample_id""",
    "arr_context": f"""{_T} SELECT sample_id, {sql_listed("x[len(x) // 4 + 1:2 * (len(x) // 4)]")} AS share, {sql_listed("x[4:13]")} AS part FROM t""",
    "arr_cut_pairs": f"""{_T}, w AS (SELECT sample_id, x, y, COALESCE(list_filter(range(1, len(y) + 1), lambda i: y[i] <> -100)[1] - 1, len(y)) AS p FROM t WHERE len(x) = len(y)), l AS (SELECT *, len(x) + 2 - p AS t FROM w),
        m AS (SELECT *, CASE WHEN t * 2 < 512 THEN 512 WHEN p * 2 < 512 THEN 512 - p ELSE CAST(trunc(512 * (CAST(t AS DOUBLE) / (p + t))) AS BIGINT) END AS most FROM l), c AS (SELECT *, LEAST(most, t) AS b, LEAST(GREATEST(512 - LEAST(most, t), 0), p) AS a FROM m),
        s AS (SELECT 0 AS side, sample_id, x AS x, p, a, b FROM c UNION ALL SELECT 1, sample_id, list_concat(x, [1, 2]), p, a, b FROM c)
        SELECT side, sample_id, {sql_listed("list_concat(x[1:a], x[p + 1:p + b])")} AS ids, {sql_listed("list_concat(list_transform(range(0, a), lambda i: -100), x[p + 1:p + b])")} AS labels FROM s""",
    "arr_plain_cut": f"{_T} SELECT sample_id, {sql_listed('x[1:100]')} AS cut FROM t",
    "pack_totals": f"""{_T}, f AS (SELECT x, list_concat(y, list_transform(range(0, GREATEST(len(x) - len(y), 0)), lambda i: -100))[1:len(x)] AS y FROM t WHERE len(x) > 0 AND len(x) < {LENGTH})
        SELECT CAST(COUNT(*) AS BIGINT) AS samples, CAST(SUM(len(x)) AS BIGINT) AS tokens, CAST(SUM(list_sum(x)) AS BIGINT) AS id_sum, CAST(SUM(list_sum(y)) AS BIGINT) AS label_sum, CAST({LENGTH} AS INT) AS shortest, CAST({LENGTH} AS INT) AS longest FROM f""",
    "collated_batches": f"""WITH t AS (SELECT sample_id, sample_id // 4 AS g, COALESCE(input_ids, []) AS x, COALESCE(labels, []) AS y FROM sft_tokens), m AS (SELECT *, CAST(ceil(MAX(len(x)) OVER (PARTITION BY g) / 64.0) * 64 AS BIGINT) AS n FROM t)
        SELECT sample_id, {sql_listed(f"list_concat(x, list_transform(range(0, n - len(x)), lambda i: {PAD}))")} AS ids, {sql_listed("list_concat(list_concat(y, list_transform(range(0, GREATEST(len(x) - len(y), 0)), lambda i: -100))[1:len(x)], list_transform(range(0, n - len(x)), lambda i: -100))")} AS labels,
        {sql_listed("list_concat(list_transform(x, lambda v: 1), list_transform(range(0, n - len(x)), lambda i: 0))")} AS mask FROM m""",
    "loader_single": "SELECT doc_id, pos, CAST((pos % 32) // 4 AS INT) AS rank FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents) WHERE pos >= 100",
    "loader_cyclic": f"{_BUCKETS} SELECT doc_id, pos, rank FROM q WHERE pos >= 4",
    "rank_domains": "SELECT CAST(w AS INT) AS world, CAST(t AS INT) AS tensor, CAST(p AS INT) AS pipeline, CAST((r % (w // p)) // t AS INT) AS part, CAST(r AS INT) AS rank FROM (SELECT w, t, p, unnest(range(0, w)) AS r FROM (VALUES (8, 2, 2), (16, 4, 1), (16, 2, 4)) v(w, t, p))",
    "ranks_in_turn": "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) % 6 AS rank FROM documents",
    "sample_provenance": """WITH d AS (SELECT doc_id, strlen(text) AS n FROM documents WHERE strlen(text) > 0), s AS (SELECT doc_id, n, SUM(n) OVER (ORDER BY doc_id) - n AS start FROM d), t AS (SELECT (SUM(n) - 1) // 65536 AS c FROM d), g AS (SELECT unnest(range(0, CAST(c AS BIGINT))) AS sample FROM t),
        j AS (SELECT sample, list(doc_id ORDER BY doc_id) AS l FROM g JOIN s ON s.start < sample * 65536 + 65537 AND s.start + s.n > sample * 65536 GROUP BY sample)
        SELECT CAST(sample AS BIGINT) AS sample, md5(array_to_string(l, ',') || repeat(',-100', 65537 - len(l))) AS document_ids, md5(CAST(sample AS VARCHAR) || repeat(',-100', 65536)) AS idx FROM j""",
    "epochs_planned": f"""WITH t AS (SELECT SUM(strlen(text)) AS t FROM documents), n AS (SELECT unnest([1, 100, 1000, 123456]) AS n), e AS (SELECT n, t, GREATEST(1, CAST(ceil((n * {LENGTH} + 1) / CAST(t AS DOUBLE)) AS BIGINT)) AS e, (t - 1) // {LENGTH} AS per FROM n, t)
        SELECT CAST(n AS BIGINT) AS samples, CAST(t AS BIGINT) AS tokens, e AS epochs, n > per AND n - (CAST(ceil(n / CAST(per AS DOUBLE)) AS BIGINT) - 1) * per < CAST(trunc(0.8 * per) AS BIGINT) AS apart FROM e""",
    "validation_split": "SELECT doc_id, pos < n AS held FROM (SELECT doc_id, row_number() OVER (ORDER BY md5(concat_ws('-', '3', doc_id)), doc_id) - 1 AS pos, CAST(ceil(COUNT(*) OVER () * CAST(0.1 AS DOUBLE)) AS BIGINT) AS n FROM documents)",
    "stream_split": "SELECT doc_id, pos, pos < 50 AS held FROM (SELECT doc_id, row_number() OVER (ORDER BY md5(concat_ws('-', '8', doc_id)), doc_id) - 1 AS pos FROM documents)",
    "stream_resumed": "SELECT * FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS ord FROM documents) WHERE ord >= 123",
    "sub_ranges": "WITH n AS (SELECT COUNT(*) AS n FROM documents) SELECT CAST(i AS INT) AS part, i * 64 AS first, LEAST((i + 1) * 64, n) AS last FROM (SELECT n, unnest(range(0, (n + 63) // 64)) AS i FROM n)",
    "padded_parts": "WITH p AS (SELECT doc_id, CAST(ntile(7) OVER (ORDER BY doc_id) - 1 AS INT) AS part FROM documents), n AS (SELECT COUNT(*) % 7 AS r FROM documents) SELECT doc_id, part, FALSE AS padding FROM p UNION ALL SELECT (SELECT MIN(doc_id) FROM documents), CAST(k AS INT), TRUE FROM (SELECT unnest(range(r, 7)) AS k FROM n WHERE r > 0)",
    "split_intersection": "WITH n AS (SELECT COUNT(*) AS n FROM documents) SELECT 'train' AS split, CAST(0 AS BIGINT) AS first, CAST(round_even(0.8 * n, 0) AS BIGINT) AS last FROM n UNION ALL SELECT 'valid', CAST(round_even(0.9 * n, 0) AS BIGINT), CAST(round_even(0.95 * n, 0) AS BIGINT) FROM n UNION ALL SELECT 'test', NULL, NULL",
    "resampled_rows": f"""WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY md5(concat_ws('-', '5', doc_id)), doc_id) - 1 AS draw, COUNT(*) OVER () AS n FROM documents), m AS (SELECT unnest(range(n, 2 * n + 77)) AS d, n FROM (SELECT COUNT(*) AS n FROM documents))
        SELECT doc_id, draw FROM p UNION ALL SELECT p.doc_id, m.d FROM m JOIN p ON p.draw = {_RANDOM("5-draw", "m.d")} % m.n""",
    "bucketed_epoch": f"{_BUCKETS} SELECT rank, doc_id, pos FROM q",
    "permutations": _REPEATS.format(extra="(64 - n % 64) % 64", order="e, md5(concat_ws('-', '3', e, c, doc_id)), c, o"),
    "permutations_reshuffled": _REPEATS.format(extra="0", order="md5(concat_ws('-', '3', e, c, doc_id)), e, c, o"),
    "blend_drawn": _drawn(3, "1.0", True),
    "blend_first_exhausted": _drawn(4, "n", False),
    "blend_languages": """WITH RECURSIVE g AS (SELECT lang, COUNT(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang), s AS (SELECT list(n ORDER BY lang) AS n, CAST(SUM(n) AS BIGINT) AS total FROM g),
        r AS (SELECT 0 AS i, list_transform(n, lambda x: CAST(0 AS BIGINT)) AS c, CAST(0 AS BIGINT) AS p, CAST(0 AS BIGINT) AS k FROM s
        UNION ALL SELECT i + 1, list_transform(c, lambda x, j: x + CASE WHEN j = p THEN 1 ELSE 0 END), p, c[p] FROM (SELECT i, c, CAST(list_position(e, list_max(e)) AS BIGINT) AS p FROM (SELECT i, c, list_transform(n, lambda x, j: CASE WHEN c[j] < x THEN CAST(x AS DOUBLE) / total * GREATEST(i, 1) - c[j] ELSE -1e18 END) AS e FROM r, s WHERE i < total))),
        d AS (SELECT doc_id, lang, dense_rank() OVER (ORDER BY lang) AS p, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS k FROM documents WHERE lang IS NOT NULL)
        SELECT CAST(r.i - 1 AS BIGINT) AS pos, d.doc_id, d.lang FROM r JOIN d ON d.p = r.p AND d.k = r.k WHERE r.i > 0""",
    "blend_by_weight": """WITH RECURSIVE s AS (SELECT CAST(COUNT(*) // 3 AS BIGINT) AS m FROM documents), t AS (SELECT CAST(ceil(m * CAST(0.5 AS DOUBLE)) + ceil(m * CAST(0.3 AS DOUBLE)) + ceil(m * CAST(0.2 AS DOUBLE)) AS BIGINT) AS n FROM s),
        r AS (SELECT 0 AS i, [0, 0, 0] AS c UNION ALL SELECT i + 1, list_transform(c, lambda x, j: x + CASE WHEN j = p THEN 1 ELSE 0 END) FROM (SELECT i, c, list_position(e, list_max(e)) AS p FROM (SELECT i, c, [CAST(0.5 AS DOUBLE) * GREATEST(i, 1) - c[1], CAST(0.3 AS DOUBLE) * GREATEST(i, 1) - c[2], CAST(0.2 AS DOUBLE) * GREATEST(i, 1) - c[3]] AS e FROM r)) WHERE i < (SELECT n FROM t))
        SELECT CAST(k - 1 AS SMALLINT) AS dataset_id, CAST(c[k] AS BIGINT) AS n, CAST(c[k] - 1 AS BIGINT) AS last FROM (SELECT c, unnest([1, 2, 3]) AS k FROM r WHERE i = (SELECT n FROM t))""",
    "vocabulary_sizes": "SELECT CAST(n AS INT) AS size, CAST((n + 127) // 128 * 128 AS INT) AS padded, CAST(65 + n % 26 AS INT) AS token FROM (SELECT unnest(range(250, 400, 7)) AS n)",
    "texts_decoded": "SELECT doc_id, text FROM documents",
}
