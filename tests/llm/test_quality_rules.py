import random
from collections import Counter
from string import ascii_letters, ascii_lowercase, digits

import zstandard
from conftest import SF
from fixtures import messy_rows

from wattline.llm.catalog import QUERIES
from wattline.llm.quality import BANDS, Limits, measure

SPACE = " \t\n\r\x0b\x0c"


def plain(text, limits=Limits()):
    """The counts character by character."""
    text = text or ""
    words, word = [], ""
    for c in text + " ":
        if c in SPACE:
            words += [word] if word else []
            word = ""
        else:
            word += c
    lines = [x for x in text.split("\n") if any(c not in SPACE for c in x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = sum(any(often[windows[j]] > 1 for j in range(max(0, i - 2), min(i + 1, len(windows)))) for i in range(len(words)))
    failed = len(words) < 50 or 100 * repeated > 50 * len(words)

    def fits(data):
        low, high = [b[1:] for b in BANDS if len(data) < b[0]][0]
        return low <= len(zstandard.ZstdCompressor(level=limits.level).compress(data)) / len(data) <= high

    data, kept = text.encode(), False
    if not failed:
        chunks = [data[i : i + limits.chunk] for i in range(0, len(data), limits.chunk)]
        bad = sum(len(c) for c in chunks if not fits(c)) if len(chunks) > 1 else 0
        kept = fits(data) and bad <= limits.share * len(data)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, repeated, failed, kept


def test_query_equals_plain_count(spark):
    got = {r.doc_id: tuple(r)[1:7] + (r.kept,) for r in QUERIES["op4_compression_bands"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got == {r.doc_id: plain(r.text) for r in docs}


def test_messy_texts():
    packer = zstandard.ZstdCompressor(level=3)
    for r in messy_rows():
        m = measure(r[1], packer, Limits())
        assert m[:6] + m[8:] == plain(r[1])


def test_repetitive_and_incompressible_chunks_are_rejected():
    rng = random.Random(3)
    packer = zstandard.ZstdCompressor(level=3)
    vocabulary = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 7))) for _ in range(3000)]
    good = " ".join(rng.choices(vocabulary, k=3000))
    noise = " ".join("".join(rng.choices([chr(c) for c in range(33, 127)], k=30)) for _ in range(400))
    assert measure(good, packer, Limits())[-1]
    assert not measure(noise, packer, Limits())[-1]
    blank = "".join(f"{i % 97} " for i in range(4000))
    assert not measure(good + blank * 2, packer, Limits())[-1]


def noise(rng, kind, size):
    """Words of eight base64 characters, hex digits, or of 2 to 8 random letters."""
    out = ""
    while len(out) < size:
        alphabet, n = {"base64": (ascii_letters + digits + "+/", 8), "hex": ("0123456789abcdef", 8), "letters": (ascii_lowercase, rng.randint(2, 8))}[kind]
        out += "".join(rng.choices(alphabet, k=n)) + " "
    return out[:size]


def test_noise_of_few_symbols_is_rejected():
    """Each kind from the length on from which good documents compress better by more than the margin."""
    rng = random.Random(8)
    packer = zstandard.ZstdCompressor(level=3)
    for kind, least in (("base64", 470), ("letters", 4200), ("hex", 8300)):
        for size in (470, 700, 1500, 3000, 4200, 6000, 8300, 12000, 24000, 50000):
            found = measure(noise(rng, kind, size), packer, Limits())
            assert not found[5] and (size < least or not found[-1]), (kind, size, found)


def test_labelled_good_documents_are_not_too_dense(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").select("doc_id")
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(labels, "doc_id").select("text").collect()
    packer = zstandard.ZstdCompressor(level=3)
    found = [m for m in (measure(r.text, packer, Limits()) for r in docs) if not m[5]]
    assert found and all(m[-1] for m in found)
