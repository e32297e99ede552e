"""Query of the quality classifier. SQL cannot express it; a test holds it against held-out labels."""

from churnkit.llm.frames import table
from churnkit.llm.quality_model import score, train
from churnkit.llm.registry import query


@query("op7_quality_classifier")
def op7_quality_classifier(spark, sf_dir):
    """Quality score of every document, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
