"""Fuzzy attribution of contact-log users to call-centre agents.

Score of a (user, agent) pair = mean over the agent's name tokens of the best
Ratcliff-Obershelp ratio (``difflib.SequenceMatcher(None, agent_tok,
user_tok).ratio()``) against the user's tokens.  Winner per user: the first
agent (ordered by name, centre) scoring >= ``accept``; else the best agent
(first on ties) scoring >= ``fallback``; else ``SIN ASIGNAR``.

No cross join: a pair can only score >= fallback if at least one token pair
has ratio >= fallback (a mean reaches the threshold only if some term does).
Such token pairs are found exactly with prefix filtering on character
multisets (ratio = 2M/(la+lb) and M <= multiset overlap), an equi-join on
rare characters.  Of the (user, agent) pairs linked by such a token pair only
those are scored whose upper bound (per agent token the best that shared
characters allow, in SQL functions) reaches the threshold, and their token pairs
are made distinct first: the Python ratio, an Arrow-batched pandas UDF, sees a
token pair once per use, however many names hold it.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from collectra.functions.columns import q
from collectra.functions.text import name_tokens
from collectra.schemas import ALL_CENTERS, FUZZY_ACCEPT, FUZZY_FALLBACK
from collectra.session import fresh_path

UNASSIGNED = "SIN ASIGNAR"


@F.pandas_udf(DoubleType())
def token_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    from difflib import SequenceMatcher
    return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


# Prefix-filter element order: letters from rarest to most common in
# Spanish-language names; characters not listed sort first (rarer still).
# Any fixed total order keeps the filter exact; rarity only prunes more.
RARITY_ORDER = "wkxyqzjhfvbgpcmudtlsnoiera"


def _elements(t):
    """Character occurrences ``char#k`` (k-th time the char appears), in the global order."""
    chars = F.split(t, "")
    els = F.transform(chars, lambda c, i: F.struct(
        F.instr(F.lit(RARITY_ORDER), c).alias("r"),
        (-F.size(F.filter(F.slice(chars, 1, i + 1), lambda x: x == c))).alias("nk"),
        c.alias("c")))
    return F.transform(F.array_sort(els), lambda x: F.concat(x["c"], F.lit("#"), (-x["nk"]).cast("string")))


def _prefix(els, frac: float):
    """Prefix of a token's elements: a token of length L needs overlap >=
    ceil(frac * L) with any partner reaching the threshold, so its first
    L - need + 1 elements are enough for an exact equi-join."""
    need = F.ceil(F.size(els) * F.lit(frac) - F.lit(1e-9)).cast("int")
    return F.slice(els, 1, F.greatest(F.size(els) - need + 1, F.lit(1)))


def similar_token_pairs(agent_tokens: DataFrame, user_tokens: DataFrame, threshold: float) -> DataFrame:
    """All (ta, tu) with ratio(ta, tu) >= threshold, found without a cross join.

    ratio >= t needs overlap M >= t/2 (la+lb) and lb >= t/(2-t) la, hence
    M >= ceil(t/(2-t) * la): prefix filtering with that bound per token is
    exact.  Equal tokens (ratio 1) are an equi-join of their own; the others
    reach Python only if their whole multiset overlap allows the threshold.
    """
    a = agent_tokens.select("ta").distinct()
    u = user_tokens.select("tu").distinct()
    equal = a.join(u, F.col("ta") == F.col("tu")).withColumn("r", F.lit(1.0))
    cand = similar_candidates(a, u, threshold)
    return equal.unionByName(cand.withColumn("r", token_ratio("ta", "tu")).where(F.col("r") >= threshold))


def similar_candidates(a: DataFrame, u: DataFrame, threshold: float) -> DataFrame:
    """Different (ta, tu) whose character multisets overlap enough: 2M >= t (la+lb)."""
    frac = threshold / (2.0 - threshold)
    pa = a.withColumn("ea", _elements(F.col("ta"))).select("ta", "ea", F.explode(_prefix(F.col("ea"), frac)).alias("e"))
    pu = u.withColumn("eb", _elements(F.col("tu"))).select("tu", "eb", F.explode(_prefix(F.col("eb"), frac)).alias("e"))
    both = F.size("ea") + F.size("eb")
    return (pa.join(pu, "e").where((F.col("ta") != F.col("tu"))
                                   & (2 * F.size(F.array_intersect("ea", "eb")) >= F.lit(threshold) * both - 1e-9))
            .select("ta", "tu").distinct())


def agent_reference(calls: DataFrame, name_col: str = "Nombre_Call") -> DataFrame:
    cc_col = "Call_Center_Limpio" if "Call_Center_Limpio" in calls.columns else "Call_Center"
    ref = (calls.select(q(name_col).alias("a_name"), q(cc_col).cast("string").alias("a_cc"))
           .where(F.col("a_cc").isNotNull() & (F.col("a_cc") != "") & F.col("a_name").isNotNull())
           .distinct())
    return ref.withColumn("a_tok", name_tokens(F.col("a_name"))).where(F.size("a_tok") > 0)


HOT_USERS = 10_000  # users of one token that a task joins with the agents of similar ones


def linked_pairs(hits: DataFrame, aa: DataFrame, ua: DataFrame) -> DataFrame:
    """(u_name, a_name, a_cc) of users and agents that share a similar token pair.

    A token that many users hold is dealt out by a salt of the user; the agents
    that it links go along with each share.
    """
    shares = ua.groupBy("tu").agg(F.ceil(F.count(F.lit(1)) / HOT_USERS).cast("int").alias("shares"))
    asked = (hits.join(aa.select("ta", "a_name", "a_cc"), "ta").join(shares, "tu")
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).select("tu", "salt", "a_name", "a_cc").distinct())
    held = ua.join(shares, "tu").select("tu", F.pmod(F.xxhash64("u_name"), F.col("shares")).cast("int").alias("salt"), "u_name")
    return asked.join(held, ["tu", "salt"]).select("u_name", "a_name", "a_cc").distinct()


def score_bound(agent_elements, user_elements):
    """Upper bound of a pair's score: the mean, over the agent's tokens, of the
    best that a user token's shared characters allow (2M / (la + lb))."""
    best = F.transform(agent_elements, lambda a: F.array_max(F.transform(
        user_elements, lambda u: 2.0 * F.size(F.array_intersect(a, u)) / (F.size(a) + F.size(u)))))
    return F.aggregate(best, F.lit(0.0), lambda x, y: x + y) / F.size(agent_elements)


def pair_scores(users: DataFrame, agents: DataFrame, fallback: float = FUZZY_FALLBACK) -> DataFrame:
    """(u_name, a_name, a_cc, score) of all pairs scoring ``fallback`` or more.

    A linked pair is scored only if its bound allows ``fallback``; Python sees a
    pair of different tokens once, however many names hold it.
    """
    users = users.withColumn("u_tok", name_tokens(F.col("u_name"))).where(F.size("u_tok") > 0)
    ua = users.select("u_name", F.explode(F.array_distinct("u_tok")).alias("tu"))
    aa = agents.select("a_name", "a_cc", F.explode(F.array_distinct("a_tok")).alias("ta"))
    hits = similar_token_pairs(aa, ua, fallback).select("ta", "tu")
    elements = lambda c: F.transform(c, _elements)
    pairs = (linked_pairs(hits, aa, ua)
             .join(agents.select("a_name", "a_cc", "a_tok", elements("a_tok").alias("ae")), ["a_name", "a_cc"])
             .join(users.select("u_name", "u_tok", elements("u_tok").alias("ue")), "u_name")
             .where(score_bound(F.col("ae"), F.col("ue")) >= F.lit(fallback) - 1e-9)
             .select("u_name", "a_name", "a_cc", "a_tok", "u_tok"))
    # both uses below read the pairs that passed, not their joins
    path = fresh_path(users.sparkSession, "fuzzy")
    pairs.write.parquet(path)
    pairs = users.sparkSession.read.schema(pairs.schema).parquet(path)
    full = (pairs.select("u_name", "a_name", "a_cc", "u_tok", F.posexplode("a_tok").alias("i", "ta"))
            .select("u_name", "a_name", "a_cc", "i", "ta", F.explode("u_tok").alias("tu")))
    ratios = full.where(F.col("ta") != F.col("tu")).select("ta", "tu").distinct().withColumn("r", token_ratio("ta", "tu"))
    best = (full.join(ratios, ["ta", "tu"], "left").withColumn("r", F.coalesce("r", F.lit(1.0)))
            .groupBy("u_name", "a_name", "a_cc", "i").agg(F.max("r").alias("r")))
    # summed in the order of the agent's tokens: the same rounding on every run
    of = F.transform(F.array_sort(F.collect_list(F.struct("i", "r"))), lambda x: x["r"])
    score = best.groupBy("u_name", "a_name", "a_cc").agg(of.alias("of")).select(
        "u_name", "a_name", "a_cc", (F.aggregate("of", F.lit(0.0), lambda x, y: x + y) / F.size("of")).alias("score"))
    return score.where(F.col("score") >= fallback)


def candidates_of(scores: DataFrame, accept: float = FUZZY_ACCEPT) -> DataFrame:
    """Per (user, centre) what a choice among centres needs: the first agent
    accepted (``first_ok``) and the best one (``best``, ``best_score``)."""
    best = F.min(F.struct((-F.col("score")).alias("s"), "a_name"))
    return scores.groupBy("u_name", "a_cc").agg(
        F.min(F.when(F.col("score") >= accept, F.col("a_name"))).alias("first_ok"), best.alias("b")).select(
        "u_name", "a_cc", "first_ok", F.col("b.a_name").alias("best"), (-F.col("b.s")).alias("best_score"))


def choose_centers(candidates: DataFrame, restricted=None, centers=ALL_CENTERS) -> DataFrame:
    """(u_name, Call_Center): the winner among the agents of the ``restricted`` centres (all, if None).

    Users without a candidate agent are absent (the caller defaults them)."""
    if restricted is not None:
        candidates = candidates.where(F.col("a_cc").isin(*restricted))
    win = candidates.groupBy("u_name").agg(
        F.min_by("a_cc", F.when(F.col("first_ok").isNotNull(), F.struct("first_ok", "a_cc"))).alias("first_ok"),
        F.min_by("a_cc", F.struct((-F.col("best_score")).alias("s"), "best", "a_cc")).alias("best"))
    cc = F.coalesce("first_ok", "best")
    return win.select("u_name", F.when(cc.isin(*centers), cc).otherwise(F.lit(UNASSIGNED)).alias("Call_Center"))


def user_centers(users: DataFrame, agents: DataFrame, accept: float = FUZZY_ACCEPT,
                 fallback: float = FUZZY_FALLBACK, centers=ALL_CENTERS) -> DataFrame:
    """Distinct user names (column ``u_name``) -> attributed centre.

    Users without a candidate agent are absent (the caller defaults them)."""
    return choose_centers(candidates_of(pair_scores(users, agents, fallback), accept), centers=centers)


def _user_column(contacts: DataFrame) -> str:
    return "Nombre_Usuario" if "Nombre_Usuario" in contacts.columns else "Usuario_Novedad"


def _stripped(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def _users(contacts: DataFrame) -> DataFrame:
    return contacts.select(q(_user_column(contacts)).alias("u_name")).where(F.col("u_name").isNotNull()).distinct()


def center_candidates(contacts: DataFrame, calls: DataFrame, accept: float = FUZZY_ACCEPT,
                      fallback: float = FUZZY_FALLBACK) -> DataFrame:
    """What a report keeps of the fuzzy match: the candidates of every user of its contact log.

    A score depends on its two names only, so a filter on clients or centres
    chooses among these rows and needs no match of its own."""
    return candidates_of(pair_scores(_users(_stripped(contacts)), agent_reference(_stripped(calls)), fallback), accept)


def attribute(contacts: DataFrame, winners: DataFrame) -> DataFrame:
    """Contacts with the ``Call_Center`` of their user's row in ``winners`` (one row per user)."""
    contacts = _stripped(contacts)
    # AQE broadcasts the winners at runtime when their measured size is small,
    # otherwise this stays a shuffle join
    out = contacts.join(winners, q(_user_column(contacts)) == winners.u_name, "left").drop("u_name")
    return out.withColumn("Call_Center", F.coalesce(q("Call_Center"), F.lit(UNASSIGNED)))


def fuzzy_agent_match(contacts: DataFrame, calls: DataFrame, accept: float = FUZZY_ACCEPT,
                      fallback: float = FUZZY_FALLBACK, centers=ALL_CENTERS) -> DataFrame:
    """Contacts with ``Call_Center`` attributed from the contact user's name."""
    return attribute(contacts, choose_centers(center_candidates(contacts, calls, accept, fallback), centers=centers))
