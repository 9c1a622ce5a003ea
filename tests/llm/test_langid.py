import pytest
from pyspark.sql import functions as F

from cleanlane.llm import langid

SAID = {
    "en": "the quick brown fox and the lazy dog were walking through that old forest with their friends",
    "de": "der schnelle braune fuchs und der faule hund gingen durch den alten wald mit ihren freunden",
    "fr": "le renard brun et rapide et le chien paresseux marchaient dans la vieille forêt avec leurs amis",
    "es": "el rápido zorro marrón y el perro perezoso caminaban por el viejo bosque con sus amigos",
}


@pytest.fixture(scope="module")
def model(frame):
    rows = [(text[i:] + " " + text, lang) for lang, text in SAID.items() for i in range(0, 40, 4)]
    return langid.fit(frame([*rows, (None, "en"), ("xx", None), ("привет", "ru")], "text string, lang string"))


def test_text_decides_and_everything_else_helps(frame, model):
    rows = [(f"p{lang}{i}", f"http://{lang}.example.com/{i}", f'<html lang="{lang}"><script>the der le</script><p>{text[i:]}</p>') for lang, text in SAID.items() for i in range(8)]
    rows += [("short", "http://de.example.com/x", '<html lang="de">mit'), ("none", "http://de.example.com/y", "<html lang=de><p>123 ..."), ("null", None, None), ("same", "http://en.example.com", rows[0][2]), ("same", "http://en.example.com", rows[0][2])]
    out = langid.identify_pages(frame(rows, "page_id string, url string, html string"), model).collect()
    got = {r["page_id"]: r["lang"] for r in out}
    assert len(out) == len(rows)
    assert all(got[f"p{lang}{i}"] == lang for lang in SAID for i in range(8))
    assert got["short"] == "de" and got["none"] == "und" and got["null"] == "und" and got["same"] == "en"


def test_accepted_documents_keep_their_columns(frame, model):
    rows = [(i, text, lang, "s", "clash") for i, (lang, text) in enumerate(SAID.items())]
    rows += [(10, "Съешь же ещё этих мягких французских булок, да выпей чаю. " * 5, "en", "s", None), (11, None, None, None, None), (12, "", "en", "s", None), (13, "%%% 12 !!", "en", None, None), (14, SAID["en"] * 2000, None, None, None)]
    docs = frame(rows, "doc_id long, text string, lang string, source string, HOST string")
    out = langid.accepted_documents(docs, model)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 1, 2, 3, 14]
    assert langid.accepted_documents(docs.limit(0), model).count() == 0


def test_no_labelled_rows(frame):
    none = langid.fit(frame([], "text string, lang string"))
    docs = frame([(1, "the fox", "en", "s")], "doc_id long, text string, lang string, source string")
    assert langid.accepted_documents(docs, none).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    fitted = langid.fit(docs.filter(~held))
    rest = docs.filter(held & (F.length("text") > 100)).select("text", "lang", F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("declared"))
    scored = langid.with_scores(rest, fitted, F.col("text"), [F.col("lang")]).collect()
    right = sum(fitted.languages[max(range(4), key=lambda i: r["scores"][i])] == r["c0"] for r in scored)
    assert right >= 0.99 * len(scored)


def test_hidden_parts_without_end_are_scanned_once(frame, model):
    import time

    rows = [("open", None, "<script>" * 60_000 + SAID["de"]), ("shown", None, SAID["de"] + "<!--" * 60_000), ("tags", None, "<html " * 60_000 + ">" + SAID["de"])]
    began = time.time()
    got = {r["page_id"]: r["lang"] for r in langid.identify_pages(frame(rows, "page_id string, url string, html string"), model).collect()}
    assert (got["open"], got["shown"], len(got)) == ("und", "de", 3) and time.time() - began < 60


def test_a_repeated_text_enters_the_sample_with_its_share(frame, monkeypatch):
    monkeypatch.setattr(langid, "Model", lambda counts, languages: counts.sum(axis=1))
    rows = [(SAID["en"], "en")] * 4000 + [(SAID["de"], "de")] * 4000
    fitted = langid.fit(frame(rows, "text string, lang string"), rows=400)
    one = langid.fit(frame(rows[:1] + rows[-1:], "text string, lang string"))
    shares = fitted / one.clip(1)
    assert all(20 < shares[langid.LANGUAGES.index(x)] < 400 for x in ("en", "de"))
