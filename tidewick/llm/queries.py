"""One query per operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewick.llm import align, content_sort, decontam, langid, packing, phrases, pii, planes, recurrent, severity, simhash, urls, warc
from tidewick.llm.common import table


def op1_url_trees(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"))


def op2_ordinal_severity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return severity.score(docs, severity.fit(docs, table(spark, sf_dir, "labels")))


def op3_spaced_seeds(spark, sf_dir):
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_zip_warc(spark, sf_dir):
    packages = warc.write_packages(table(spark, sf_dir, "pages"))
    return warc.read_records(warc.record_places(packages)).drop("url", "payload")


def op5_bit_planes(spark, sf_dir):
    return planes.checksums(planes.write_planes(table(spark, sf_dir, "documents")))


def op6_pattern_packing(spark, sf_dir):
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op7_centroid_language(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


def op8_recurrent_score(spark, sf_dir):
    return recurrent.score(table(spark, sf_dir, "documents"))


def op9_content_sort(spark, sf_dir):
    return content_sort.exact_groups(table(spark, sf_dir, "documents"))


def op10_simhash_groups(spark, sf_dir):
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_field_personal(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(pii.labelled(docs)))


def op12_lockstep_alignment(spark, sf_dir):
    return align.align(table(spark, sf_dir, "documents"))


def op13_suffix_phrases(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_url_trees, op2_ordinal_severity, op3_spaced_seeds, op4_zip_warc, op5_bit_planes, op6_pattern_packing, op7_centroid_language, op8_recurrent_score, op9_content_sort, op10_simhash_groups, op11_field_personal, op12_lockstep_alignment, op13_suffix_phrases)}
ORACLES = {"op4_zip_warc": warc.ORACLE, "op9_content_sort": content_sort.ORACLE, "op13_suffix_phrases": phrases.ORACLE}
