import pytest
from pyspark.sql import functions as F

from weft.functions import similarity as S
from weft.functions import text as T
from weft.functions import unicode as U
from weft.functions.hashing import crc_slot, splitmix64, unsigned_mod, validation_fold

M = (1 << 64) - 1


def mix(n):
    x = (n + 0x9E3779B97F4A7C15) & M
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & M
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & M
    return x ^ (x >> 31)


def test_splitmix_and_folds(spark):
    numbers = [0, 1, 2, 7, 12345, 9999999, 2**31, 2**40 + 3, 2**62]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    for r in df.select("n", splitmix64(F.col("n")).alias("h"), unsigned_mod(splitmix64(F.col("n")), 5).alias("m"), validation_fold(F.col("n")).alias("f")).collect():
        assert r.h & M == mix(r.n) and r.m == mix(r.n) % 5 and r.f == (mix(r.n) % 5 == 0)


def test_crc(spark):
    import zlib

    ids = ["S1-1", "S1-22", "Ünï", ""]
    df = spark.createDataFrame([(i,) for i in ids], "i string")
    assert [r.s for r in df.select(crc_slot(F.col("i"), 7).alias("s")).collect()] == [zlib.crc32(i.encode()) % 7 for i in ids]


NAMES = {
    "Café & Co. Inc": "cafe and", "Société Générale SA": "societe generale", "ÆON ßtraße LLC": "Æon ßtraße", "O’Neil—Bros": "o neil bros", "МОСКВА Ltd": "МОСКВА", "Øre AS": "ore as", "under_score": "under score", "": "", "   ": "", None: "", "Café": "cafe",
}
ADDRESSES = {"12 Main Street, Suite 5": "12 main st ste 5", "Floor 3 Building-9": "fl 3 bldg 9", None: "", " \t": ""}


def test_normalizers(spark):
    df = spark.createDataFrame([(k, v) for k, v in NAMES.items()], "raw string, want string")
    assert [r.got for r in df.select(T.normalize_name(F.col("raw")).alias("got")).collect()] == list(NAMES.values())
    df = spark.createDataFrame([(k, v) for k, v in ADDRESSES.items()], "raw string, want string")
    assert [r.got for r in df.select(T.normalize_address(F.col("raw")).alias("got")).collect()] == list(ADDRESSES.values())


def test_audit_and_sample_normalizers(spark):
    df = spark.createDataFrame([("Société & Co_x SA", "9 Main Street"), (None, None), ("", "")], "a string, b string")
    got = df.select(U.audit_normalized("a").alias("x"), U.sample_name("a").alias("y"), U.sample_address("b").alias("z"), U.case_folded("a").alias("c"), U.unicode_numbers("b").alias("n"), U.gestalt_ratio("a", "b").alias("g")).collect()
    assert (got[0].x, got[0].y, got[0].z, got[0].n) == ("socie te and co_x sa", "societe and x sa", "9 main st", ["9"])
    assert got[1].x is None and got[1].g is None and got[2].y == "" and got[2].g == 1.0


def one(spark, *cols, a="", b=""):
    return spark.createDataFrame([(a, b)], "a string, b string").select(*cols).first()


@pytest.mark.parametrize("text,tokens,grams", [("", [], []), ("b a b", ["a", "b"], None), ("é", ["é"], ["5E5EC3", "5EC3A9", "A92424", "C3A924"]), ("a", ["a"], ["5E5E61", "5E6124", "612424"])])
def test_sets(spark, text, tokens, grams):
    r = one(spark, T.token_set(F.col("a")).alias("t"), T.byte_trigrams(F.col("a")).alias("g"), a=text)
    assert r.t == tokens and (grams is None or r.g == grams)


def test_numbers_pairs_ids(spark):
    r = one(spark, T.numeric_tokens(F.col("a")).alias("n"), T.bounded_postal_tokens(F.col("a")).alias("p"), T.character_trigrams(F.col("b")).alias("c"), a="a12345b 7 654321", b="")
    assert r.n == ["12345", "654321", "7"] and r.p == ["654321"] and r.c == ["^^$", "^$$"]
    r = one(spark, T.unordered_pairs(F.array(F.lit("b"), F.lit("a"), F.lit("c"))).alias("p"), T.unordered_pairs(F.array().cast("array<string>")).alias("e"), T.id_list(F.lit(" S2-1,,S3-2\r")).alias("i"), T.id_list(F.lit(None).cast("string")).alias("z"))
    assert r.p == ["a|b", "b|c", "a|c"] and r.e == [] and r.i == ["S2-1", "S3-2"] and r.z == []
    r = one(spark, T.entity_number(F.lit("S1-007")).alias("a"), T.entity_number(F.lit("42")).alias("b"), T.entity_number(F.lit("S1-x")).alias("c"), T.entity_source(F.lit("S3-1")).alias("s"))
    assert (r.a, r.b, r.c, r.s) == (7, 42, None, 3)
    r = one(spark, T.minhash_bands(F.array(F.lit("x"), F.lit("y"))).alias("m"), T.minhash_bands(F.array().cast("array<string>")).alias("e"))
    assert len(r.m) == 32 and r.e == []


PAIRS = [("", "", 1, 1, 1, 0, 0), ("abc", "", 0, 0, 0, 0, 0), ("abc", "abc", 1, 1, 1, 1, 1), ("kitten", "sitting", 0, 2 / 17, 1 - 3 / 7, 0, 6 / 7), ("é", "e", 0, 0, 0, 0, 0.5)]


@pytest.mark.parametrize("a,b,jac,dice,edit,cont,length", PAIRS)
def test_similarities(spark, a, b, jac, dice, edit, cont, length):
    x, y = F.col("a"), F.col("b")
    r = one(spark, S.jaccard(T.token_set(x), T.token_set(y)), S.dice(T.byte_trigrams(x), T.byte_trigrams(y)), S.edit_similarity(x, y), S.containment(x, y), S.length_ratio(x, y), a=a, b=b)
    assert list(r) == pytest.approx([jac, dice, edit, cont, length])


@pytest.mark.parametrize("tp,pred,true,f", [(0, 0, 0, 1), (0, 1, 0, 0), (0, 0, 2, 0), (2, 4, 2, 0.5555556)])
def test_f_beta(spark, tp, pred, true, f):
    lit = lambda v: F.lit(float(v))
    assert one(spark, S.f_beta(lit(tp), lit(pred), lit(true)).alias("f")).f == pytest.approx(f)
