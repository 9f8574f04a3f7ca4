"""Language detectors: a function of a text column that gives struct(lang, score), ('unk', 0.0) where nothing is known."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import col, let

Detector = Callable[[Column], Column]

#: Function words that few of the other languages share.
VOTES = {
    "en": "the of and to in is was that it for with as his he be at by had not are but from or have an they which their this were",
    "fr": "le la les des du et un une est dans que qui au aux pour sur pas ne se ce avec sont cette mais ou nous vous leur",
    "de": "der die das und ist nicht ein eine den dem des mit von zu auf für im sich auch als an es werden aus bei nach wie",
    "es": "el la los las de que y en un una es por con para del se su al lo como más pero sus le ya o este muy",
    "it": "il lo la gli le di che e un una è per con del della nel alla si non sono da come più anche ma questo molto dei",
    "nl": "de het een en van is dat niet in op te zijn voor met die aan ook als bij naar uit maar werd door nog om wordt over",
}


def _hits(tok: Column, words: list[str]) -> Column:
    return F.size(F.filter(tok, lambda x: x.isin(words)))


def lexical(c) -> Column:
    """Votes of function words: the share of the best language among all votes; ties go to the first of the list."""
    tok = F.regexp_extract_all(F.lower(F.coalesce(col(c), F.lit(""))), F.lit(r"\p{L}+"), F.lit(0))
    tok = F.filter(tok, lambda x: x.isin(sorted({w for ws in VOTES.values() for w in ws.split()})))

    def counted(t):
        return F.array(*[F.struct(_hits(t, ws.split()).alias("n"), F.lit(-i).alias("rank"), F.lit(k).alias("lang")) for i, (k, ws) in enumerate(VOTES.items())])

    def best(v):
        total = F.aggregate(v, F.lit(0), lambda a, x: a + x["n"])
        top = F.array_max(v)
        return F.when(total > 0, F.struct(top["lang"].alias("lang"), (top["n"] / total).alias("score"))).otherwise(F.struct(F.lit("unk").alias("lang"), F.lit(0.0).alias("score")))

    return let(let(tok, counted), best)
