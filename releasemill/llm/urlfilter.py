"""URL filter: host and path rules, then logistic regression on hashed character n-grams."""

from __future__ import annotations

import binascii
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from releasemill.llm.frames import extended

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BUCKETS = 1 << 14
GRAMS = (3, 4, 5)
# Rows of the labelled table that are taken to the driver to fit the model.
TRAINING_ROWS = 10_000
# Share of URLs that are to be blocked, before anything is known of one.
PRIOR = 0.25


@dataclass(frozen=True)
class Rule:
    """`verdict` (allow or block) for a host, its subdomains and paths that start with `path`."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the production filter.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)

# The small labelled URL table (1: block, 0: allow), of usual kinds of sites.
# Both labels have the same top domains, prefixes and kinds of paths, so that these tell nothing.
LABELLED = (
    (1, """
www.luckycasino.com/slots/bonus
royal-casino-online.org/en/12
casino-jackpots.net/roulette
bestpoker-room.com/fr/7.html
blog.poker-deposit.org/en/register
sportsbets24.net/de/305
www.bets-and-odds.com/signup
betting-tips-vip.org/es/48/
m.bingo-slots.net/free-spins
viagra-online.com/en/12
discount-pills.org/en/no-prescription
pills-express.net/fr/7.html
www.cheapmeds-rx.com/tramadol
weight-loss-miracle.org/de/305
diet-pills-now.net/en/buy
adultcams.com/es/48/
blog.adult-dating.org/en/join
xxxvideos.net/en/12
www.hot-xxx-girls.com/12
sexchat-live.org/fr/7.html
m.porn-tube.net/en/99
escort-girls.com/de/305
adserver.trackingpixel.org/click/88
ads.clickbanner.net/es/48/
www.popunder-ads.com/serve/13
tracker.adclicks.org/en/12
adtrack-pixel.net/imp/31
spammail-blast.com/fr/7.html
blog.spamlinks.org/submit
linkfarm-seo.net/de/305
www.buy-backlinks.com/pagerank
article-spinner.org/es/48/
m.replica-watches.net/rolex
cheap-handbags.com/en/12
cheap-jerseys.org/en/wholesale
payday-cash.net/fr/7.html
www.fastloans-nocredit.com/en/now
free-gift-cards.org/de/305
winprize.net/you-won
free-ringtones.com/es/48/
blog.get-free-coins.org/hack
paypa1-secure.net/en/12
www.account-update.com/login/confirm
crackz-keygen.org/fr/7.html
m.warez-full.net/en/crack
torrent-cracked.com/de/305
make-money-fast.org/start
crypto-doubler.net/es/48/
www.slotmachines-vip.com/en/12
blackjack-online.org/fr/7.html
lottery-winner-today.net/de/305
cialis-generic.com/es/48/
blog.steroids-shop.org/about
hair-growth-pills.net/index.html
www.webcam-girls.com/en/12
nude-pics.org/fr/7.html
m.adult-toys-cheap.net/de/305
banner-exchange-ads.com/es/48/
click-tracker.org/about
pixel-ads-server.net/index.html
www.email-spam-tool.com/en/12
guest-post-links.org/fr/7.html
rank-booster-seo.net/de/305
fake-rolex-replica.com/es/48/
blog.debt-free-loans.org/about
gift-card-winner.net/index.html
www.bank-login-verify.com/en/12
password-reset-secure.org/fr/7.html
m.cracked-software.net/de/305
serial-keygen.com/es/48/
earn-cash-home.org/about
forex-profit-bot.net/index.html
"""),
    (0, """
www.university.com/admissions/dates
physics.university.org/en/12
library.city.net/en/opening-hours
parliament.com/fr/7.html
blog.weather.national.org/forecast/7
museum-of-nature.net/de/305
www.hospital-trust.com/departments
school.district.org/es/48/
m.news.dailypost.net/2021/05/story.html
evening-times.com/en/12
regional-radio.org/programmes/en/4
magazine.science.net/fr/7.html
www.docs.framework.com/en/guide/install.html
wiki.opensource.org/de/305
forum.gardeners.net/topic/812
cooking-recipes.com/es/48/
blog.travelnotes.org/en/2018/lisbon
mountain-hiking.net/en/12
www.cityguide.com/de/verkehr
train-times.org/fr/7.html
m.books.publisher.net/catalogue/1204
orchestra.com/de/305
film-archive.org/es/colecciones/6
theatre.town.net/es/48/
www.chess-club.com/members/44
football-league.org/en/12
running.athletics.net/en/records
maths.tutorials.com/fr/7.html
blog.languages.school.org/es/curso/2
history.essays.net/de/305
www.weather-station.org/de/305
newspaper.net/en/471
m.photography.com/es/48/
engineering.org/en/685/
shop.bookstore.net/en/12
recipes.kitchen.com/de/252
www.astronomy.observatory.org/fr/7.html
local-history.net/fr/874
pharmacy-college.com/de/305
public-library.org/en/free-events
blog.adult-education.net/es/48/
agriculture.com/en/12
www.airport.org/fr/7.html
algebra.net/de/305
m.anatomy.com/es/48/
architecture.org/about
bakery.net/index.html
ballet.com/en/12
www.beekeeping.org/fr/7.html
biology.net/de/305
botany.com/es/48/
bridge-building.org/about
blog.brass-band.net/index.html
bus-timetable.com/en/12
www.carpentry.org/fr/7.html
cathedral.net/de/305
m.ceramics.com/es/48/
choir.org/about
climate.net/index.html
college-alumni.com/en/12
www.computing.org/fr/7.html
cricket.net/de/305
dentist.com/es/48/
dictionary.org/about
blog.drawing.net/index.html
economics.com/en/12
www.electronics.org/fr/7.html
embroidery.net/de/305
m.encyclopedia.com/es/48/
family-tree.org/about
fire-brigade.net/index.html
fishing.com/en/12
www.forestry.org/fr/7.html
geography.net/de/305
glaciers.com/es/48/
grammar.org/about
blog.handwriting.net/index.html
harbour.com/en/12
www.insects.org/fr/7.html
journalism.net/de/305
m.kindergarten.com/es/48/
knitting.org/about
lighthouse.net/index.html
linguistics.com/en/12
www.literature.org/fr/7.html
medicine.net/de/305
meteorology.com/es/48/
mineral-collection.org/about
blog.nursing.net/index.html
parish.com/en/12
www.philosophy.org/fr/7.html
"""),
)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table: `host, path, label` (1: block)."""
    rows = []
    for label, text in LABELLED:
        for line in text.split():
            host, _, path = line.partition("/")
            rows.append((host, f"/{path}", label))
    return spark.createDataFrame(rows, "host string, path string, label int")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.coalesce(F.translate(host, UPPER, LOWER), empty), F.coalesce(path, empty)


def ruled(host: Column, path: Column, rules: Iterable[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = (host == rule.host) | host.endswith(f".{rule.host}")
        fits &= path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.text)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def features(host: str, path: str, buckets: int = BUCKETS) -> np.ndarray:
    """Distinct buckets of the character n-grams of host and path, kept apart by a mark."""
    found = set()
    for mark, part in ((b"h", host), (b"p", path)):
        raw = b"^" + part.encode("utf-8", "surrogatepass") + b"$"
        for n in GRAMS:
            for k in range(len(raw) - n + 1):
                found.add(binascii.crc32(raw[k : k + n], ord(mark) * 31 + n) % buckets)
    return np.fromiter(sorted(found), dtype=np.int64, count=len(found))


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def block(self, host: str, path: str) -> float:
        """Probability that a URL is to be blocked."""
        own = features(host, path, len(self.weights))
        z = self.bias + self.weights[own].sum() / np.sqrt(max(1, len(own)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(labelled: DataFrame, buckets: int = BUCKETS, steps: int = 400, rate: float = 0.5,
        penalty: float = 1e-3) -> Model:
    """Logistic regression by gradient descent over at most TRAINING_ROWS labelled URLs.

    Rows without a label are ignored, null host or path count as empty.  Without
    rows of both labels the model allows everything.
    """
    rows = (
        labelled.where("label is not null").select("host", "path", "label")
        .orderBy(F.xxhash64("host", "path"), "label").limit(TRAINING_ROWS).collect()
    )
    weights, labels = np.zeros(buckets), np.array([float(r.label) for r in rows])
    if len(set(labels)) < 2:
        return Model(weights, -30.0)
    own = [features(r.host or "", r.path or "", buckets) for r in rows]
    row = np.repeat(np.arange(len(own)), [len(x) for x in own])
    column = np.concatenate(own)
    value = np.concatenate([np.full(len(x), 1 / np.sqrt(max(1, len(x)))) for x in own])
    share = np.where(labels == 1, PRIOR / labels.sum(), (1 - PRIOR) / (1 - labels).sum())
    bias = 0.0
    for _ in range(steps):
        z = np.bincount(row, weights[column] * value, len(own)) + bias
        error = (1 / (1 + np.exp(-z)) - labels) * share * len(own)
        weights -= rate * (np.bincount(column, error[row] * value, buckets) / len(own) * 10 + penalty * weights)
        bias -= rate * error.mean()
    return Model(weights, float(bias))


def judged(pages: DataFrame, model: Model, rules: Iterable[Rule] = RULES,
           id_column: str = "page_id", url: str = "url") -> DataFrame:
    """`id, host, path, rule, block_score, verdict` of every row.

    verdict is that of the longest rule that fits; without a rule it is block
    where the model's probability is 0.5 or more.  A null URL and one without
    `://` have empty host and path and are judged like others.  Repeated rows all
    come back, an empty table gives none.
    """
    host, path = host_and_path(F.col(f"`{url}`").cast("string"))
    split = pages.select(F.col(f"`{id_column}`"), host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    both = split.select("*", rule.alias("rule"), verdict.alias("ruled"),
                        F.struct("host", "path").alias("__own"))

    def make():
        known: dict[tuple, float] = {}

        def scores(values):
            if len(known) > 100_000:
                known.clear()
            out = []
            for v in values:
                own = (v["host"], v["path"])
                if own not in known:
                    known[own] = model.block(*own)
                out.append(known[own])
            return [out]

        return scores

    scored = extended(both, "__own", [("block_score", "double", pa.float64())], make, 4096)
    method = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.select(
        id_column, "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "block_score"
    )
