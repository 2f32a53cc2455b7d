"""Work-setting classifier: Office, Hybrid, Remote or Unknown from text evidence.

All stages map over an array of text fragments inside one row, so there is no
shuffle. Fragments without a cue word of any rule are left out first. Patterns read a copy of
the text in which signs beyond ASCII give way to one that is no letter, so that a plain word
boundary means what it does in RE2, and each rule first asks whether its cue is there.
Each fragment carries its source and strength:

    4 description and role highlights, 3 title, 2 tags, 1 metadata, 0 a false flag,
    -1 company policy, -2 physical duties

The strongest evidence that says anything decides; contradiction at that
strength gives Unknown.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.columns import filled, ladder, normalized_each

# Headings, tokens and phrases of the rules.
ROLE_HEADINGS = ("responsibilities", "job responsibilities", "role", "work location", "work arrangement", "schedule", "description")
METADATA_REMOTE = ("remote", "work from home", "wfh")
METADATA_HYBRID = ("hybrid",)
METADATA_OFFICE = ("onsite", "on-site", "on site", "in office", "office")
ALTERNATIVES = r"(?i)\b(in[- ]person|remote|hybrid|onsite|on-site|office-based)\s*;\s*(remote|hybrid|onsite|on-site|office-based|in[- ]person)\b"
ONSITE = r"\b(?:onsite|on-site|in[- ]office)\b"
REMOTE_TECHNOLOGY = r"\bremote (?:systems?|sensing|access|control|support|desktop|monitoring)\b"
HYBRID_TECHNOLOGY = r"\b(?:no|not) hybrid\b|\bhybrid (?:cloud|systems?|architecture|infrastructure|environments?|solutions?)\b"
REMOTE_EXPERIENCE = r"\bno remote work experience\b"
ONBOARDING = r"\b(?:onsite|on-site|in[- ]office)\b[^.;]{0,45}\b(?:onboarding|orientation)\b"
FEW_DAYS = r"\b(?:[1-5]|one|two|three|four|five) (?:business )?days?\b"
THEN_REMOTE = r"\b(?:then|thereafter|followed by) (?:fully |100% )?remote\b"
LONG_ONSITE = r"\bfirst (?:[a-z0-9]+ )?(?:weeks?|months?|years?)\b|\bremote\b[^.;]{0,100}\bthen (?:work )?(?:onsite|on-site|in[- ]office)\b"
WEEKLY_REMOTE = r"\bremote [1-4] days? (?:per|a|each) week\b"
ALTERNATING = r"\balternat(?:e|ing) weeks?\b"
ANY_REMOTE = r"\b(?:remote|remotely|from home)\b"
EXCLUSIVE = r"\b(?:fully|100%|exclusively|strictly) (?:remote|onsite|on-site|in[- ]office)\b"
NOT_RECURRING = r"\b(?:annual|onboarding|orientation)\b"
SOME_CANDIDATES = r"\bfor candidates (?:based|living|located)[^.;]{0,110}\b(?:hybrid|onsite|on-site|remote)\b"
REMOTE_OR_BASED = r"\bremote or [a-z -]{1,30}based\b|\boffice[^.;]{0,20}\bor (?:via )?(?:a )?remote\b"
TRANSITION = r"\b(?:remote|onsite|on-site|office-based|in-person)\b[^.;]{0,100}\b(?:first (?:[a-z0-9]+ )?(?:days?|weeks?|months?|years?)|thereafter|subsequently|then (?:fully )?(?:remote|onsite|on-site|office-based|in-person))\b"
NEGATED_REMOTE = r"\bremote|remotely|home\b"
TITLE_HYBRID = r"(?:^hybrid\s*(?:[-:]|$)|[(\[]\s*hybrid\s*[)\],:-])"
TITLE_OFFICE = r"\b(?:onsite|on-site|in-office)\b"
TITLE_REMOTE = r"\bremote\b"
TITLE_NOT_REMOTE = r"\bnon-remote\b"
SOMETIMES = r"\b(?:occasional|occasionally|occasions|annual|once a year|onboarding|orientation|as needed|as required|when needed|when required|periodically|periodic|from time to time|ad hoc)\b|\bif (?:this|the) (?:position|role) is (?:listed|designated)\b|\b(?:not|no) (?:required (?:to be )?)?(?:onsite|on-site|in-office|in-person)\b"
NO_COMPONENT = r"\b(?:fully|100%|exclusively|only|strictly|annual|year|travel|onboarding|orientation)\b"
TAG = r"#li-(?:remote|hybrid|onsite|on-site)\b"
# Words without which no rule of their kind can hold.
REMOTE_CUES = ("remote", "home", "wfh")
HYBRID_CUES = ("hybrid",)
SITE_CUES = ("onsite", "on-site", "on site", "office", "person")
DUTY_CUES = (
    "patient", "injection", "immunization", "vaccine", "phlebotomy", "blood draw", "physical", "forensic", "nursing care", "helicopter", "aircraft", "airplane", "air transportation",
    "inspection", "forklift", "lathe", "machine", "equipment", "inmate", "detainee", "prisoner",
)
# A sentence is tried from its start only: the pattern begins with all signs of a sentence, so no later start finds more.
LOGISTICS = r"(?:^|(?<=[.;]))" + P.OFFICE_LOGISTICS
LOGISTICS_CUE = r"interview|application|recruit|training|orientation|onboarding|conference|meetup|event"

#: Fields of one piece of evidence, in the order of the metadata.
EVIDENCE = "struct<source:string,text:string,normalized:string,strength:int,setting:string,conflict:boolean,negative_remote:boolean,office_days:bigint,remote_days:bigint>"


def _any(*patterns: str) -> str:
    return "|".join(patterns)


def _says(x: Column, cues: tuple[str, ...]) -> Column:
    return reduce(or_, (F.contains(x, F.lit(c)) for c in cues))


def _plain(x: Column) -> Column:
    """x with one sign that is no letter for each beyond ASCII."""
    return F.regexp_replace(x, r"[^\x00-\x7F]", "\x01")


def matches(x: Column, pattern: str) -> Column:
    return F.regexp_like(x, F.lit(pattern))


def without(x: Column, pattern: str) -> Column:
    return F.regexp_replace(x, pattern, "")


def _days(x: Column, pattern: str) -> Column:
    """The number of days that a pattern captures; null without a match."""
    return F.regexp_extract(x, pattern, 1).try_cast("bigint")


def _with(i: Column, names: tuple[str, ...], **more: Column) -> Column:
    """The named fields of a struct, and more."""
    return F.struct(*(i[c].alias(c) for c in names), *(v.alias(k) for k, v in more.items()))


def _fragment(source: Column | str, text: Column, strength: Column | int) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(lit(source).alias("source"), text.alias("text"), lit(strength).cast("int").alias("strength"))


def inputs() -> Column:
    """Text fragments of a listing with source and strength, blanks left out."""
    none = F.array().cast("array<struct<source:string,text:string,strength:int>>")
    rejoined = F.regexp_replace(F.coalesce("job_description", F.lit("")), P.java(ALTERNATIVES), "$1 or $2")
    sentences = F.transform(F.split(rejoined, "[.;]+"), lambda x: _fragment("description", x, 4))
    roles = F.filter("work_setting_highlights", lambda h: F.lower(F.btrim(h["title"])).isin(*ROLE_HEADINGS))
    flag = F.col("work_from_home")
    parts = [
        F.array(_fragment("title", F.col("job_title"), 3)),
        sentences,
        F.transform(roles, lambda h: _fragment(F.concat(F.lit("highlight:"), h["title"]), h["item"], 4)),
        F.transform("work_setting_extensions", lambda x: _fragment("serpapi_extension", x, 1)),
        F.transform(F.split(F.coalesce("work_setting_source_metadata", F.lit("")), "·"), lambda x: _fragment("linkedin_preferences", x, 1)),
        F.when(flag.isNotNull(), F.array(_fragment("serpapi_wfh", flag.cast("string"), flag.cast("int")))),
    ]
    return F.filter(F.concat(*(F.coalesce(p, none) for p in parts)), lambda i: filled(i["text"]).isNotNull())


_GIVEN = ("source", "text", "strength", "normalized")


def _cued(i: Column) -> Column:
    """A fragment with the copy that patterns read, and which kinds of cues it has."""
    n = i["normalized"]
    return _with(i, _GIVEN, plain=_plain(n), far=_says(n, REMOTE_CUES), mixed=_says(n, HYBRID_CUES), site=_says(n, SITE_CUES), duty=_says(n, DUTY_CUES))


_CUED = (*_GIVEN, "plain", "far", "mixed", "site", "duty")


def _speaks(i: Column) -> Column:
    return i["far"] | i["mixed"] | i["site"] | i["duty"] | (i["source"] == "serpapi_wfh")


def _stripped(i: Column) -> Column:
    """Without neutral phrases on remote work, and without logistics and denials of office work."""
    n, far = i["plain"], i["far"]
    substantive = matches(n, _any(P.OFFICE_SUBSTANTIVE, P.OFFICE_WEEK, P.OFFICE_DAYS_LEAD))
    at_work = F.when(i["site"] & matches(n, LOGISTICS_CUE) & ~substantive, without(n, LOGISTICS)).otherwise(n)
    return _with(i, _CUED, at_work=at_work, neutral=F.when(far, without(n, P.REMOTE_NEUTRAL)).otherwise(n), inexperienced=far & matches(n, REMOTE_EXPERIENCE))


def _scrubbed(i: Column) -> Column:
    return _with(
        i, (*_CUED, "neutral", "inexperienced"),
        no_duty=F.when(i["site"], without(i["at_work"], P.OFFICE_NEGATION)).otherwise(i["at_work"]),
        contextual=F.when(i["inexperienced"], without(without(i["plain"], REMOTE_EXPERIENCE), P.REMOTE_NEUTRAL)).otherwise(i["neutral"]),
    )


def _denied(i: Column) -> Column:
    """Without denials."""
    deniable = i["far"] | i["mixed"]
    return _with(
        i, (*_CUED, "no_duty", "contextual"),
        positive=F.when(deniable, without(i["contextual"], P.NEGATION)).otherwise(i["contextual"]),
        offered=F.when(deniable, without(i["neutral"], P.NEGATION)).otherwise(i["neutral"]),
        office_context=F.when(i["site"], without(i["no_duty"], P.OFFICE_LABEL_NEGATION)).otherwise(i["no_duty"]),
    )


_KEPT = (*_CUED, "contextual", "positive", "office_context")


def _counted(i: Column) -> Column:
    """With the days named."""
    remote = F.coalesce(
        _days(i["offered"], P.REMOTE_WEEK), F.when(i["site"] & matches(i["plain"], _any(P.OFFICE_WEEK, P.OFFICE_DAYS_LEAD)), _days(i["plain"], P.REMOTE_TAIL)),
        F.when(matches(i["offered"], P.FRIDAY_HOME), F.lit(1).cast("bigint")),
    )
    office = F.coalesce(_days(i["no_duty"], P.OFFICE_WEEK), _days(i["no_duty"], P.OFFICE_DAYS_LEAD))
    return _with(i, _KEPT, office_days=F.when(i["site"], office), remote_days=F.when(i["far"], remote), role=i["strength"] >= 3)


def _scoped(i: Column) -> Column:
    """Whether a fragment speaks of a short introduction on site, or of a recurring mix."""
    text, both = i["contextual"], i["office_days"].isNotNull() & i["remote_days"].isNotNull()
    short = i["far"] & i["site"] & matches(text, ONBOARDING) & matches(text, FEW_DAYS) & matches(text, _any(P.ROLE_REMOTE, THEN_REMOTE)) & ~matches(text, LONG_ONSITE)
    remote_part = both | matches(i["positive"], _any(P.ROLE_REMOTE, P.REMOTE_WEEK, WEEKLY_REMOTE)) | (matches(text, ALTERNATING) & matches(text, ANY_REMOTE))
    mix = (
        i["far"] & i["site"] & (F.length(text) <= 240) & (both | matches(text, P.RECURRING)) & matches(i["office_context"], ONSITE) & remote_part
        & (~both | (i["office_days"] + i["remote_days"] <= 5))
        & ~matches(i["positive"], EXCLUSIVE) & ~matches(text, _any(NOT_RECURRING, REMOTE_TECHNOLOGY))
    )
    return _with(i, (*_KEPT, "office_days", "remote_days", "role"), short_onboarding=short, mix=mix)


def _signals(i: Column) -> Column:
    text, positive, office, title, far = i["contextual"], i["positive"], i["office_context"], i["source"] == "title", i["far"]
    settled = far | i["mixed"] | i["site"]
    ambiguous = settled & (matches(positive, P.AMBIGUITY) | matches(text, SOME_CANDIDATES) | matches(text, REMOTE_OR_BASED) | (~i["short_onboarding"] & matches(text, TRANSITION)))
    hybrid = i["mix"] | (i["mixed"] & (matches(positive, P.ROLE_HYBRID) | (title & matches(text, TITLE_HYBRID) & ~matches(text, HYBRID_TECHNOLOGY))))
    on_site = i["site"] & (matches(without(office, P.NEGATION), P.ROLE_OFFICE) | (title & matches(office, TITLE_OFFICE))) & ~matches(text, SOMETIMES)
    remote = far & (
        (i["remote_days"].isNotNull() & ~matches(text, P.NEGATION))
        | matches(without(positive, REMOTE_TECHNOLOGY), P.ROLE_REMOTE)
        | (i["short_onboarding"] & matches(text, THEN_REMOTE))
        | (title & matches(text, TITLE_REMOTE) & ~matches(text, _any(P.NEGATION, TITLE_NOT_REMOTE, REMOTE_TECHNOLOGY)))
    )
    denied = far & F.exists(F.regexp_extract_all(text, F.lit(P.NEGATION), F.lit(0)), lambda n: matches(n, NEGATED_REMOTE))
    role = i["role"]
    return _with(i, (*_CUED, "contextual", "office_days", "remote_days", "role", "mix"), ambiguous=role & ambiguous, hybrid=role & hybrid, office=role & on_site, remote=role & remote, negative_remote=denied)


def _evidence(i: Column, source: Column, strength: Column | int, setting: Column | str, conflict: Column | bool = False, negative: Column | bool = False, office: Column | None = None, remote: Column | None = None, text: Column | None = None, normalized: Column | None = None) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    values = (source, i["text"] if text is None else text, i["normalized"] if normalized is None else normalized, lit(strength).cast("int"), lit(setting), lit(conflict), lit(negative), lit(office), lit(remote))
    names = ("source", "text", "normalized", "strength", "setting", "conflict", "negative_remote", "office_days", "remote_days")
    return F.struct(*(v.alias(n) for v, n in zip(values, names, strict=True))).cast(EVIDENCE)


def _direct(i: Column) -> Column:
    metadata, n = i["source"].isin("serpapi_extension", "linkedin_preferences"), i["normalized"]
    setting = ladder([
        (i["ambiguous"], "Unknown"), (i["hybrid"], "Hybrid"), (i["office"] & i["remote"], "Unknown"), (i["office"], "Office"), (i["remote"], "Remote"),
        (metadata & n.isin(*METADATA_REMOTE), "Remote"), (metadata & n.isin(*METADATA_HYBRID), "Hybrid"), (metadata & n.isin(*METADATA_OFFICE), "Office"),
        ((i["source"] == "serpapi_wfh") & (n == "true"), "Remote"),
    ], "Unknown")
    clash = (
        i["ambiguous"] | (i["office"] & i["remote"] & ~i["mix"])
        | (i["hybrid"] & ~i["mix"] & ((i["office"] & i["office_days"].isNull()) | (i["remote"] & i["remote_days"].isNull())))
        | ((i["source"] == "title") & i["hybrid"] & (i["office"] | i["remote"]))
    )
    partial = ~i["ambiguous"] & ~i["negative_remote"] & ~matches(i["contextual"], NO_COMPONENT)
    return _evidence(i, i["source"], i["strength"], setting, clash, i["negative_remote"], F.when(i["office"] & partial, i["office_days"]), F.when(i["remote"] & partial, i["remote_days"]))


def evidence(signals: Column) -> Column:
    """Direct evidence, tags, company policy and physical duties, in this order."""
    of_metadata = lambda i: i["source"].isin("serpapi_extension", "linkedin_preferences") & i["normalized"].isin(*METADATA_REMOTE, *METADATA_HYBRID, *METADATA_OFFICE)
    direct = F.filter(signals, lambda i: i["hybrid"] | i["office"] | i["remote"] | i["ambiguous"] | i["negative_remote"] | of_metadata(i) | (i["source"] == "serpapi_wfh"))
    roles = F.filter(signals, lambda i: i["role"])
    tag_setting = lambda t: ladder([(t == "#li-remote", "Remote"), (t == "#li-hybrid", "Hybrid")], "Office")
    tagged = F.filter(roles, lambda i: F.contains(i["plain"], F.lit("#li-")))
    tags = F.flatten(F.transform(tagged, lambda i: F.transform(F.regexp_extract_all(i["plain"], F.lit(TAG), F.lit(0)), lambda t: _evidence(i, F.concat(i["source"], F.lit(":li_tag")), 2, tag_setting(t)))))
    prose = F.filter(roles, lambda i: i["source"] != "title")
    remote, hybrid = (lambda i: i["far"] & matches(i["contextual"], P.COMPANY_REMOTE)), (lambda i: i["mixed"] & matches(i["contextual"], P.COMPANY_HYBRID))
    policy = F.filter(prose, lambda i: (remote(i) | hybrid(i)) & ~matches(i["contextual"], P.COMPANY_GUARD))
    policy = F.transform(policy, lambda i: _evidence(i, F.concat(F.lit("company_policy:"), i["source"]), -1, ladder([(remote(i) & hybrid(i), "Unknown"), (remote(i), "Remote")], "Hybrid"), remote(i) & hybrid(i)))
    duties = F.filter(prose, lambda i: i["duty"] & ~i["ambiguous"] & ~i["negative_remote"] & matches(i["contextual"], _any(P.PHYSICAL_CARE, P.PHYSICAL_OPERATIONS)) & ~matches(i["contextual"], P.PHYSICAL_GUARD))
    duties = F.transform(duties, lambda i: _evidence(i, F.concat(F.lit("physical_duties:"), i["source"]), -2, "Office"))
    return F.concat(F.transform(direct, _direct), tags, policy, duties)


def weekly_mixes(found: Column) -> Column:
    """Office days and home days of one source that fit into a week together make a hybrid week."""

    def pairs(o: Column) -> Column:
        fits = lambda r: (o["source"] == r["source"]) & (o["strength"] == r["strength"]) & (o["office_days"] + r["remote_days"] <= 5) & ~o["conflict"] & ~r["conflict"] & ~o["negative_remote"]
        made = lambda r: _evidence(o, F.concat(o["source"], F.lit(":weekly_mix")), o["strength"], "Hybrid", text=F.concat_ws(". ", o["text"], r["text"]), normalized=F.concat_ws(". ", o["normalized"], r["normalized"]))
        return F.transform(F.filter(found, lambda r: F.coalesce(fits(r), F.lit(False))), made)

    return F.flatten(F.transform(found, pairs))


def classify(listings: DataFrame) -> DataFrame:
    """listings with work_setting and work_setting_metadata in place of the classifier's inputs."""
    steps = (
        listings.withColumn("ws_raw", inputs())
        .withColumn("ws_text", normalized_each(F.transform("ws_raw", lambda i: i["text"])))
        .withColumn("ws_in", F.zip_with("ws_raw", "ws_text", lambda i, n: F.struct(i["source"].alias("source"), i["text"].alias("text"), i["strength"].alias("strength"), n.alias("normalized"))))
        .withColumn("ws_cued", F.filter(F.transform("ws_in", _cued), _speaks))
    )
    before = "ws_cued"
    for k, stage in enumerate((_stripped, _scrubbed, _denied, _counted, _scoped, _signals)):
        steps, before = steps.withColumn(f"ws_{k}", F.transform(before, stage)), f"ws_{k}"
    steps = steps.withColumn("ws_found", evidence(F.col(before)))
    steps = steps.withColumn("ws_evidence", F.concat("ws_found", weekly_mixes(F.col("ws_found"))))
    speaks = lambda e: (e["setting"] != "Unknown") | e["conflict"] | e["negative_remote"]
    steps = steps.withColumn("ws_strength", F.array_max(F.transform(F.filter("ws_evidence", speaks), lambda e: e["strength"])))
    steps = steps.withColumn("ws_top", F.filter("ws_evidence", lambda e: F.coalesce(e["strength"] == F.col("ws_strength"), F.lit(False))))
    hybrid_beside = lambda e: F.exists("ws_top", lambda h: (h["setting"] == "Hybrid") & ~h["conflict"] & ((h["source"] == e["source"]) | (h["source"] == F.concat(e["source"], F.lit(":weekly_mix")))))
    effective = F.transform("ws_top", lambda e: F.when((e["office_days"].isNotNull() | e["remote_days"].isNotNull()) & hybrid_beside(e), F.lit("Hybrid")).otherwise(e["setting"]))
    steps = steps.withColumn("ws_known", F.array_distinct(F.filter(effective, lambda s: s != "Unknown")))
    clash = F.exists("ws_top", lambda e: e["conflict"]) | (F.size("ws_known") > 1) | (F.exists("ws_top", lambda e: e["negative_remote"]) & F.exists("ws_top", lambda e: e["setting"] == "Remote"))
    steps = steps.withColumn("ws_conflict", clash).withColumn("ws_setting", F.array_max("ws_known"))
    conflict, setting, strength = F.col("ws_conflict"), F.col("ws_setting"), F.col("ws_strength")
    rule = ladder([
        (conflict, "conflicting_or_ambiguous_evidence"), (setting.isNull(), "insufficient_evidence"), (strength >= 3, "explicit_role_setting"),
        (strength == 2, "li_tag_fallback"), (strength == -1, "company_policy_inference"), (strength == -2, "physical_duties_inference"),
    ], "metadata_fallback")
    confidence = ladder([(conflict | setting.isNull() | (strength < 0), "low"), (strength >= 3, "high")], "medium")
    metadata = F.to_variant_object(F.struct(rule.alias("rule"), F.col("ws_evidence").alias("evidence"), confidence.alias("confidence"), conflict.alias("conflict")))
    done = steps.withColumn("work_setting", F.when(conflict, "Unknown").otherwise(F.coalesce(setting, F.lit("Unknown")))).withColumn("work_setting_metadata", metadata)
    gone = [c for c in done.columns if c.startswith("ws_")]
    return done.drop(*gone, "work_setting_extensions", "work_setting_highlights", "work_from_home", "work_setting_source_metadata")
