"""URL filter: host and path rules, and logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.llm.tables import ascii_lower

BUCKETS = 1 << 13
_GRAMS = (3, 4, 5)

#: Words from which the labelled table is made, by what a site is for. They are common words
#: of public block list and web directory categories, written down from general knowledge; no row of a
#: table that is judged has been looked at for them.
UNWANTED = {
    "gambling": "casino poker slots roulette blackjack jackpot betting bets bet bookmaker lottery bingo wager gamble odds".split(),
    "medicine": "viagra cialis pills pharmacy meds tramadol steroids weightloss diet supplements".split(),
    "adult": "adult porn xxx sex escort nude cams hentai fetish webcam dating".split(),
    "money": "payday loans loan credit forex crypto bitcoin investment cashback earn rich prize winner giveaway replica".split(),
    "adverts": "ads ad adserver advert banner banners popup popunder tracker track tracking click clicks pixel affiliate sponsor".split(),
    "spam": "spam seo backlinks linkfarm links farm doorway traffic bulk spammer clickbait".split(),
    "piracy": "warez torrent crack keygen serial nulled pirated cracked".split(),
    "fraud": "phishing malware verify-account login-update security-alert unlock wallet-update".split(),
}
WANTED = {
    "learning": "university school college library science physics biology history mathematics institute academy research lecture journal".split(),
    "news": "news times herald tribune daily weekly reporter press radio gazette".split(),
    "home": "garden recipes cooking kitchen bread soup family house furniture carpentry knitting pets".split(),
    "travel": "travel maps hotel railway station trains museum gallery castle island mountain hiking".split(),
    "arts": "music opera theatre poetry novels painting photo film festival orchestra books".split(),
    "public": "city county council parliament ministry court hospital health weather police post".split(),
    "technology": "software docs wiki forum code linux database network compiler hardware electronics".split(),
    "people": "blog notes diary thoughts portfolio community society club church charity".split(),
}
#: Words that stand beside others in hosts of either kind.
BESIDE = "best top free online my the new world net web live pro club shop store site hub zone center team group now today big cheap win direct".split()
ONSETS = "b c d f g h j k l m n p qu r s t v w y z br ch cl cr dr fl fr gl gr pl pr sc sh sl sp st th tr wh".split() + [""]
NUCLEI = "a e i o u y ai ea ee ia ie io oo ou".split()
CODAS = "b d f g k l m n p r s t x ck ld ll mp nd ng nt rd rn rt sh ss st th".split() + [""] * 20
ENDINGS = "com net org info biz io co.uk de fr es".split()
PLACES = "en de fr es about index.html page archive 2019 2021 article item view contact list posts category search".split()


def labelled_urls(rows: int = 6000, seed: int = 11) -> list[tuple[str, int]]:
    """A labelled table made by a rule from the words above: 1 for URLs to be blocked (one in three), 0 for others.

    A host has one or two words, a word of the list and one that stands beside
    others, or, for most of the wanted ones, a made-up name of syllables; then
    an ending. Paths are of the same kind for both labels.
    """
    rng = np.random.default_rng(seed)
    pick = lambda words: words[int(rng.integers(len(words)))]
    out = []
    for k in range(rows):
        label = int(k % 3 == 0)
        words = [w for group in (UNWANTED if label else WANTED).values() for w in group]
        if not label and rng.random() < 0.7:
            name = "".join(pick(ONSETS) + pick(NUCLEI) + pick(CODAS) for _ in range(int(rng.integers(1, 5))))
        else:
            parts = [pick(words)]
            if rng.random() < 0.7:
                parts.insert(int(rng.integers(2)), pick(words if rng.random() < 0.3 else BESIDE))
            name = pick(["-", ""]).join(parts)
        before = pick(["", "", "www.", "m.", "blog.", "shop."])
        places = "".join("/" + (pick(PLACES) if rng.random() < 0.7 else str(int(rng.integers(1000)))) for _ in range(int(rng.integers(0, 4))))
        out.append((f"{pick(['http', 'https'])}://{before}{name}.{pick(ENDINGS)}{places or pick(['', '/'])}", label))
    return out


def held_out(url: str) -> bool:
    """Whether a labelled URL is kept from training: a quarter, by the name before the ending, so that no name is on both sides."""
    return crc32(split(url)[0].removeprefix("www.").split(".")[-2 if "." in split(url)[0] else 0].encode()) % 4 == 0


class Rule(NamedTuple):
    """``host`` and its subdomains, on paths that begin with ``path``."""

    verdict: str
    host: str
    path: str


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def grams(host: str, path: str) -> np.ndarray:
    """The buckets of a URL's character n-grams; host and path have n-grams of their own."""
    marked = (f"^{host}$", f"{path}$")
    return np.unique([crc32(f"{k}{part[i : i + n]}".encode()) % BUCKETS for k, part in enumerate(marked) for n in _GRAMS for i in range(max(0, len(part) - n + 1))] or [0])


def split(url: str | None) -> tuple[str, str]:
    """Host, A-Z lowered, and path; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    rest = rest.split("#", 1)[0].split("?", 1)[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def train(urls: Sequence[tuple[str | None, int]], rounds: int = 600, rate: float = 5.0, decay: float = 1e-5) -> Model:
    """Logistic regression by gradient descent over the whole table. An empty table allows everything."""
    weights, bias = np.zeros(BUCKETS), -2.0
    rows = [grams(*split(url)) for url, _ in urls]
    y = np.array([label for _, label in urls], float)
    if not rows:
        return Model(weights, bias)
    bucket, row = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.bincount(row, weights[bucket], len(rows)) - bias))
        step = np.bincount(bucket, (y - p)[row], BUCKETS)
        weights += rate * (step / len(rows) - decay * weights)
        bias += rate * (y - p).mean()
    return Model(weights, bias)


def measured(model: Model, urls: Sequence[tuple[str, int]]) -> tuple[float, float]:
    """(precision, recall) of blocking by the model alone."""
    blocked = [bool(model.weights[grams(*split(url))].sum() + model.bias >= 0) for url, _ in urls]
    right = sum(b and y for b, (_, y) in zip(blocked, urls))
    return right / max(1, sum(blocked)), right / max(1, sum(y for _, y in urls))


def default_model() -> Model:
    """The model of the labelled table above, without its held-out part."""
    return train([(url, label) for url, label in labelled_urls() if not held_out(url)])


def judge(pages: DataFrame, rules: Sequence[Rule], model: Model, *, key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, score, verdict) for every row; other columns are not read.

    The longest fitting rule decides (of equal ones the first by text), else
    the model: block from probability one half on. A null URL or one without
    ``://`` has an empty host and path, which fit no rule with a host. Repeated
    rows give repeated rows.
    """
    rest = F.substring_index(F.substring_index(F.substr(url, F.instr(url, "://") + 3), "#", 1), "?", 1)
    known = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    host = F.when(known, ascii_lower(F.substring_index(rest, "/", 1))).otherwise("")
    path = F.when(known, F.regexp_replace(rest, r"^[^/]*", "")).otherwise("")
    parts = pages.select(F.col(key), host.alias("host"), path.alias("path"), F.col(url).alias("_url"))
    fits = [
        F.when(((F.col("host") == r.host) | F.endswith("host", F.lit("." + r.host))) & F.startswith("path", F.lit(r.path)), F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in sorted(rules, key=lambda r: (-len(r.host + r.path), r.host + r.path))
    ]
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    ruled = parts.withColumn("_rule", F.coalesce(*fits, none))
    sent = pages.sparkSession.sparkContext.broadcast(model)
    schema = ruled.select(key, "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("ruled")).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            z = np.array([m.weights[g].sum() for g in map(grams, batch.column(1).to_pylist(), batch.column(2).to_pylist())]) + m.bias
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-z)), pa.float64())], schema=pa.schema([*batch.schema, ("score", pa.float64())]))

    scored = ruled.select(key, "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("ruled")).mapInArrow(run, schema)
    verdict = F.coalesce("ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.select(key, "host", "path", "rule", "score", verdict.alias("verdict"))
