"""A small labelled URL table: hosts that advertise against hosts of plain content.

It is built by rule from the word lists below; paths, subdomains and top-level domains are
dealt to both classes alike, so that only names tell them apart.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, SparkSession

#: Words of hosts that sell, lure or track (label 1, block).
UNWANTED = (
    "adult ads adserver banner bet bets betting bitcoin-double bonus casino cheap clickbait "
    "cracked dating escort forex free-gift gambling jackpot keygen loans lottery payday pharma "
    "pills poker popunder porn replica sex slots spam spam-link sweepstake track tracker "
    "viagra warez webcam win-prize xxx"
).split()

#: Words they are joined with.
LURES = "best cheap club farm free hot online rx top win x track 24 deals".split()

#: Words of hosts of plain content (label 0, allow).
WANTED = (
    "archive art astronomy biology books bridge chess city coast college council culture "
    "docs east forest garden geography harbour history house journal kitchen lake language "
    "library market mathematics meadow medicine museum music nature news north notes orchard "
    "painting physics poetry press radio recipes research river school science sea society "
    "south station stone street teacher theatre town travel university valley village water "
    "weather west wiki winter wood world"
).split()

#: Syllables of names without a meaning, label 0 as well.
SYLLABLES = "ar en in or th er on an st ti la mo ve li ra ne do sa".split()

DOMAINS = ("example.com", "example.net", "example.org", "com", "net", "org")
SUBDOMAINS = ("", "www.", "m.", "blog.")
LANGUAGES = ("en", "de", "fr", "es")
ENDINGS = ("", "/", ".html")


def labelled_rows() -> list[tuple[str, int]]:
    """(url, label), a few hundred to two thousand rows."""
    bad = [f"{a}-{b}" for a, b in product(UNWANTED, LURES[::3])]
    bad += [f"{b}-{a}" for a, b in product(UNWANTED, LURES[1::4])] + UNWANTED
    good = WANTED + [f"{a}-{b}" for a, b in zip(WANTED, WANTED[7:], strict=False)]
    good += [f"{a}{b}" for a, b in zip(WANTED, WANTED[3:], strict=False)]
    good += ["".join(s) for s in product(SYLLABLES[::2], SYLLABLES, SYLLABLES[1::3])]
    rows = []
    for label, names in ((1, bad), (0, good)):
        for k, name in enumerate(names):
            host = SUBDOMAINS[k % 4] + name + "." + DOMAINS[k % 5 if k % 2 else k % 6]
            path = f"/{LANGUAGES[k // 4 % 4]}/{k * 37 % 9973}{ENDINGS[k % 3]}"
            rows.append((f"http{'s' if k % 2 else ''}://{host}{path}", label))
    return rows


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(labelled_rows(), "url string, label int")
