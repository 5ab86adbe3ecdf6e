"""A small corpus: every tenth document is junk, two are near copies, one holds a secret."""

WORDS = "the cat sat on a mat when it was late and nobody saw how far she ran from here to there".split()


def _prose(rnd, n):
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(40)) for _ in range(n)) + "."


def documents(spark, rnd):
    rows = []
    for k in range(200):
        x = _prose(rnd, 60)
        rows.append((k, " ".join(w.upper() + "!!" for w in x.split()) if k % 10 == 0 else x))
    twin = _prose(rnd, 150)
    rows += [(200, twin), (201, twin + " end"), (202, _prose(rnd, 60) + " password=hunter22")]
    return spark.createDataFrame([(k, x, "en", "s", len(x)) for k, x in rows], "doc_id long, text string, lang string, source string, n_chars long")


def marks(spark):
    return spark.createDataFrame([(k, int(k % 10 > 0), 0) for k in range(200)], "doc_id long, quality int, toxic int")
