"""Term counts on a skewed domain mix (two thirds of the papers in one
domain) against a plain-Python implementation of the rules."""

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lexitrend.constants import ACADEMIC_STOPWORDS, DOMAIN_MAP, ENGLISH_STOPWORDS, MIN_DF, MIN_DOCS_PER_YEAR
from lexitrend.operators import terms as TM
from lexitrend.plans import standins as S

from .conftest import SF_SMALL


def py_clean(s):
    s = re.sub(r"[^a-z\s]", "", (s or "").lower())
    return re.sub(r"\s+", " ", s).strip()


def py_domains(cats):
    return sorted({DOMAIN_MAP[c.split(".")[0]] for c in (cats or "").split(" ") if c.split(".")[0] in DOMAIN_MAP})


def test_skewed_counts_match_bruteforce(spark):
    p = S.papers(spark, SF_SMALL)
    skewed = p.withColumn("all_categories",
                          F.when(F.col("id") % 3 != 0, F.lit("cs.AI cs.LG")).otherwise(F.col("all_categories")))
    got = {(r.category, r.year, r.n, r.term): (r.tf, r.df)
           for r in TM.term_year_counts(TM.with_clean_text(skewed)).collect()}

    ext = set(ENGLISH_STOPWORDS) | set(ACADEMIC_STOPWORDS)
    en = set(ENGLISH_STOPWORDS)
    tf, df, docs = Counter(), Counter(), Counter()
    for r in skewed.collect():
        words = py_clean((r.title or "") + " " + (r.summary or "")).split()
        uni = [w for w in words if w not in ext and len(w) > 2]
        base = [w for w in words if w not in en and len(w) > 2]
        grams = {1: uni, 2: [" ".join(base[i:i + 2]) for i in range(len(base) - 1)],
                 3: [" ".join(base[i:i + 3]) for i in range(len(base) - 2)]}
        year = r.published_date.year
        for d in py_domains(r.all_categories):
            docs[(d, year)] += 1
            for n, gs in grams.items():
                c = Counter(gs)
                for t, k in c.items():
                    tf[(d, year, n, t)] += k
                    df[(d, year, n, t)] += 1
    exp = {k: (tf[k], df[k]) for k in tf
           if df[k] >= MIN_DF[k[2]] and docs[(k[0], k[1])] >= MIN_DOCS_PER_YEAR}
    assert got == exp
    by_dom = defaultdict(int)
    for (d, _, _, _), _v in got.items():
        by_dom[d] += 1
    assert max(by_dom, key=by_dom.get) == "computer_science"
