"""Knowledge tables in the shape that the generators take, as a view of the business tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sources.adapter import table


def _tid(number: Column) -> Column:
    return F.concat(F.lit("T"), F.lpad(number.cast("string"), 6, "0"))


def _said(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def techniques(spark: SparkSession, d: str) -> DataFrame:
    k, none = F.col("p_partkey"), F.array().cast("array<struct<id:string,name:string,note:string>>")
    tactic = lambda name: F.array(F.struct(F.lit(name).alias("name"), F.lower(F.lit(name)).alias("short_name")))
    analytic = F.struct(_said("AN", k).alias("id"), _said("Watch ", F.col("p_brand")).alias("description"), F.array(F.lit("Linux")).alias("platforms"), F.array(F.struct(F.lit("auditd").alias("name"))).alias("log_sources"))
    mitigation = lambda j: F.struct(_said("M", (k + j) % 60).alias("id"), _said("Mitigation ", (k + j) % 60).alias("name"), F.when((k + j) % 2 == 0, _said("note ", k)).otherwise("").alias("note"))
    procedure = F.struct(_said("The group ran ", _tid(k), " with ", F.repeat(F.lit("x "), 20)).alias("procedure"), _said("G", k % 9).alias("actor_id"), _said("Actor ", k % 9).alias("actor_name"), F.when(k % 8 == 1, "intrusion-set").otherwise("malware").alias("actor_type"))
    return table(spark, d, "part").select(
        _tid(k).alias("id"), F.col("p_name").alias("name"), F.when(k % 7 == 0, "").otherwise(_said(F.col("p_type"), " made as ", F.col("p_brand"))).alias("description"),
        F.when(k % 3 == 0, _said("Look for ", F.col("p_brand"))).otherwise("").alias("detection"), F.array(F.lit("Linux")).alias("platforms"),
        F.when(k % 4 == 0, tactic("Execution")).when(k % 4 == 1, tactic("Discovery")).when(k % 4 == 2, tactic("Impact")).otherwise(tactic("Collection")).alias("tactics"),
        F.when(k % 5 != 0, F.struct(_said("DS", k).alias("id"), F.array(analytic).alias("analytics"))).alias("detection_strategy"),
        F.when(k % 3 == 0, none).when(k % 3 == 1, F.array(mitigation(0))).otherwise(F.array(mitigation(0), mitigation(1))).alias("mitigations"),
        F.when(k % 4 == 1, F.array(procedure)).alias("procedure_examples"),
    )


def rules(spark: SparkSession, d: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    yaml = _said("selection:\n  Image|endswith: x", k, "\n  CommandLine: -l\ncondition: selection")
    return table(spark, d, "orders").select(
        _said("rule-", k).alias("rule_id"), _said("Rule ", k).alias("title"), F.when(k % 11 == 0, "").otherwise(_said("Finds ", F.col("o_orderstatus"))).alias("description"),
        F.when(k % 5 == 0, "critical").when(k % 5 == 1, "High").when(k % 5 == 2, "informational").when(k % 5 == 3, "odd").alias("level"),
        F.when(k % 13 == 0, ": : [").otherwise(yaml).alias("detection_yaml"),
        F.struct(F.when(k % 2 == 0, "windows").otherwise("linux").alias("product"), F.when(k % 3 == 0, "process_creation").when(k % 3 == 1, "dns_query").alias("category"), F.lit(None).cast("string").alias("service")).alias("logsource"),
        F.when(c % 6 == 0, F.array().cast("array<string>")).otherwise(F.array(_tid(c % 300), _tid(c % 7 + 100))).alias("mitre_techniques"),
    )


def sysmon(spark: SparkSession, d: str) -> DataFrame:
    n, kinds = F.col("event_id"), [(1, "ProcessCreate", "Image"), (3, "NetworkConnect", "DestinationHostname"), (11, "FileCreate", "TargetFilename"), (22, "DnsQuery", "QueryName"), (13, "RegistryEvent", "TargetObject")]
    of = lambda i: F.element_at(F.array(*[F.lit(k[i]) for k in kinds]), (n % 5 + 1).cast("int"))
    return table(spark, d, "events").select(
        of(0).alias("event_id"), of(1).alias("event_name"), F.when(n % 4 == 0, "exclude").otherwise("include").alias("action"), of(2).alias("field"), F.lit("is").alias("condition"), _said("v", n).alias("value"),
        F.lit(None).cast("string").alias("section"), F.when(n % 9 == 0, "short").when(n % 9 == 1, "").otherwise(_said("A note on ", F.col("event_type"), " events")).alias("comment"),
        F.when(n % 10 == 3, F.array().cast("array<string>")).otherwise(F.array(_tid(F.col("user_id") % 400), _tid(n % 3))).alias("mitre_techniques"),
    )


def mitigations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").where("s_suppkey < 40").select(_said("M", F.col("s_suppkey")).alias("id"), _said("Full ", F.col("s_name")).alias("description"))
