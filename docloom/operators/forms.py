"""Questionnaires: which questions show, which are answered, how answers read, how far a form is filled.

Answers are map<string, array<string>>; a single answer is an array of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T


def answer(answers, question) -> Column:
    return F.coalesce(F.try_element_at(T.col(answers), T.col(question)), F.array().cast("array<string>"))


def visible(answers, depends_on, values) -> Column:
    """A question without a dependency shows; else some answer of the other question must be among ``values``."""
    given = answer(answers, depends_on)
    return T.col(depends_on).isNull() | F.coalesce(F.arrays_overlap(given, T.col(values)), F.lit(False))


def answered(answers, question, kind, optional) -> Column:
    """Optional and free-text questions always count as answered, others by an answer that is not blank."""
    given = F.filter(answer(answers, question), lambda x: T.strip(x) != "")
    return F.coalesce(T.col(optional), F.lit(False)) | T.col(kind).isin("short", "long") | (F.size(given) > 0)


def shown_answer(answers, question, labels, nothing: str = "(no answer)") -> Column:
    """Labels of the answers (the raw value where an option has none), joined; ``labels`` is map<string,string>."""
    given = F.filter(answer(answers, question), lambda x: T.strip(x) != "")
    named = F.transform(given, lambda x: F.coalesce(F.try_element_at(T.col(labels), x), x))
    return F.when(F.size(given) == 0, nothing).otherwise(F.array_join(named, ", "))


def progress(done: Column, shown: Column) -> Column:
    """Aggregate: percent of shown questions that are answered, 100 when none shows."""
    n = F.count_if(shown)
    return F.when(n == 0, 100).otherwise(F.round(100 * F.count_if(shown & done) / n)).cast("long")


def complete(done: Column, shown: Column) -> Column:
    return F.bool_and(done | ~shown)


def seconds_between(start, end) -> Column:
    """Whole seconds, rounded."""
    return F.round((F.unix_micros(F.to_timestamp(end)) - F.unix_micros(F.to_timestamp(start))) / 1e6).cast("long")


# --- catalogues and answers as tables -----------------------------------------------------------

OPTION = "struct<value:string,label:string>"


def questions_of(catalogue: DataFrame, keys: list[str], sections: str = "sections") -> DataFrame:
    """(keys, section, section_place, place, fields of the question): a nested catalogue, ``sections`` an array of (section, questions array), as one row per question; places from 1."""
    each = catalogue.select(*keys, F.posexplode(sections).alias("section_place", "s"))
    rows = each.select(*keys, F.col("s.section").alias("section"), (F.col("section_place") + 1).alias("section_place"), F.posexplode("s.questions").alias("place", "q"))
    return rows.select(*keys, "section", "section_place", (F.col("place") + 1).alias("place"), "q.*")


def _same(left: list[str], right: list[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right):
        out = out & (F.col(a) == F.col(b))
    return out


def visible_questions(questions: DataFrame, answers: DataFrame, keys: list[str]) -> DataFrame:
    """The questions (keys, id, depends_on, values) with ``visible``, by a join of dependency and answered question: one without a dependency shows, else some answer
    (keys, question, value) of the other question must be among ``values``."""
    named = [f"__{k}" for k in keys]
    given = answers.groupBy(*(F.col(k).alias(n) for k, n in zip(keys, named)), F.col("question").alias("__question")).agg(F.collect_set("value").alias("__given"))  # a question's answers
    joined = questions.join(given, _same([*keys, "depends_on"], [*named, "__question"]), "left")
    hit = F.coalesce(F.arrays_overlap("__given", "values"), F.lit(False))
    return joined.select(*questions.columns, (F.col("depends_on").isNull() | hit).alias("visible"))


def shown_answers(questions: DataFrame, answers: DataFrame, keys: list[str], nothing: str = "(no answer)") -> DataFrame:
    """(keys, id, shown): each question's answers (keys, question, nth, value) in order under their options' labels, by a join of answers and options; of options with
    one value the first counts; a value without an option is shown as it is, blank ones are left out."""
    owner = [f"__{k}" for k in keys]
    each = questions.select(*(F.col(k).alias(n) for k, n in zip(keys, owner)), F.col("id").alias("__id"), F.posexplode("options").alias("__at", "__o"))
    options = each.groupBy(*owner, "__id", F.col("__o.value").alias("__value")).agg(F.min(F.struct("__at", "__o.label")).alias("__first")).select(*owner, "__id", "__value", F.col("__first.label").alias("label"))
    given = answers.where(T.strip("value") != "")
    named = given.join(options, _same([*keys, "question", "value"], [*(f"__{k}" for k in keys), "__id", "__value"]), "left").select(*keys, "question", "nth", F.coalesce("label", "value").alias("label"))
    told = named.groupBy(*(F.col(k).alias(f"__{k}") for k in keys), F.col("question").alias("__question")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nth", "label"))), lambda a: a.label), ", ").alias("shown"))
    joined = questions.select(*keys, "id").join(told, _same([*keys, "id"], [*(f"__{k}" for k in keys), "__question"]), "left")
    return joined.select(*keys, "id", F.coalesce("shown", F.lit(nothing)).alias("shown"))
