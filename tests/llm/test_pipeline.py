"""The corpus pipeline, whole, against a plain version of each stage on what the stage before it kept."""

import random
import re
import zlib
from collections import defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from quirefold.llm import toxicity
from quirefold.llm.tokens import byte_bpe

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    draw = random.Random(8)
    plain = ["".join(draw.choices("abcdefgh", k=draw.randrange(3, 8))) for _ in range(500)]
    bad = ["vexgrim", "droskul", "mirthbane", "zoltrash", "krunge"]
    docs, labels = [], []
    items = [" ".join(draw.choices(plain, k=14)) for _ in range(5)] + ["three words only"]
    for k in range(200):
        words = draw.choices(plain, k=draw.randrange(40, 160))
        toxic = int(k % 4 == 0)
        if toxic:
            words[9:9] = draw.choices(bad, k=14)
        if k % 11 == 5:
            words += items[k % 5].split()[1:12]
        if k % 50 == 7:
            words += ["three", "words", "only"]
        docs.append((k, " ".join(words)))
        labels.append((k, toxic))
    for k in range(200, 260):  # copies, exact and near
        words = docs[draw.randrange(60)][1].split(" ")
        if k % 2:
            words[draw.randrange(len(words))] = "changed"
        docs.append((k, " ".join(words)))
    docs += [(300, None), (301, ""), (302, " \n"), (303, "two words"), (304, "Two  Words"), (305, "w " * 9000)]
    folder = str(tmp_path_factory.mktemp("pipeline"))
    rows = [(d, t, "en", "s", len(t or "")) for d, t in docs]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(f"i{k}", t) for k, t in enumerate(items)], "item_id string, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    return folder, dict(docs), items


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def one_of_each(docs):
    sets, group = {d: shingles(t) for d, t in docs.items()}, {d: d for d in docs}
    for a in sorted(docs):
        for b in sorted(docs):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    return {d: t for d, t in docs.items() if group[d] == d}


def without_items(docs, items):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())

    windows = set()
    for item in items:
        w = words(item)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}

    def hit(text):
        w = words(text)
        return any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))

    return {d: t for d, t in docs.items() if not hit(t)}


def test_the_whole_pipeline(spark, sf_dir):
    folder, docs, items = sf_dir
    model = toxicity.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    clean = {d: t for d, t in docs.items() if model.probability(*model.features(model.segments(toxicity.words_of(t)))) < 0.7}
    assert 40 <= len(docs) - len(clean) <= 80
    single = one_of_each(clean)
    assert len(clean) - len(single) >= 40
    kept = without_items(single, items)
    assert 10 <= len(single) - len(kept) <= 40
    rows = corpus_pipeline.run(spark, folder).collect()
    tokenizer = Tokenizer.from_file(byte_bpe())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == kept.keys()
    for d, own in pieces.items():
        ids = [*tokenizer.encode(kept[d] or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[at : at + r.length]))
            assert r.ids_crc32 == crc
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        ends = [(r.offset, r.offset + r.length) for r in sorted(own, key=lambda r: r.offset)]
        assert [a for a, _ in ends] == [0, *(b for _, b in ends[:-1])] and ends[-1][1] <= 2048


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir[0]}/documents.parquet").selectExpr("*", "1 as row", "'x' as digest", "2 as id", "3 as _row")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir[0]).columns == docs.columns
        assert stage(spark, docs.limit(0), sf_dir[0]).count() == 0
