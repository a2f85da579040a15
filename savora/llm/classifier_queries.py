"""Quality classifier over the documents; texts labelled toxic are not trusted."""

from __future__ import annotations

from savora.llm import kneser_ney
from savora.llm.common import table
from savora.llm.queries import query


@query("op3_kneser_ney")
def _(spark, folder):
    trusted = table(spark, folder, "labels").filter("quality = 1 AND toxic = 0")
    return kneser_ney.classify(table(spark, folder, "documents"), trusted)
