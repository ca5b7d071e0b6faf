"""The views of ``bench_views.frames`` as SQL, for oracle queries run elsewhere.

Each view is a CTE over the benchmark tables; ``with_views`` puts the views a
query needs (and their dependencies) in front of it.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "src_sample_id_map": """
select md5(cast(o_orderkey as varchar(20))) as sample_id,
       concat('ERR', cast(1000000 + o_orderkey as varchar(20))) as run_ids,
       concat('S', cast(o_orderkey as varchar(20))) as sample_name,
       o_orderpriority as study_name
from orders""",
    "stg_marker_abundance": """
select md5(cast(l_orderkey as varchar(20))) as sample_id,
       concat('M', cast(l_partkey as varchar(20))) as marker_id,
       l_quantity as abundance
from lineitem""",
    "stg_marker_presence": """
select md5(cast(l_orderkey as varchar(20))) as sample_id,
       concat('M', cast(l_partkey as varchar(20))) as marker_id,
       cast(case when l_discount > 0.05 then 1 else 0 end as bigint) as presence
from lineitem""",
    "raw_rel_ab": """
select md5(cast(l_orderkey as varchar(20))) as sample_id,
       case when l_linenumber <= 2 then concat('k__', p_type)
            when l_linenumber <= 4 then concat('k__', p_type, '|p__', p_brand)
            else concat('k__', p_type, '|p__', p_brand, '|s__', p_name) end as clade_name,
       cast(l_partkey as varchar(20)) as clade_taxid,
       case when l_linenumber = 7 then 'n/a'
            else cast(cast(l_quantity as bigint) as varchar(20)) end as relative_abundance,
       case when l_returnflag = 'R' then '-'
            else cast(cast(l_quantity as bigint) + l_linenumber as varchar(20)) end as coverage,
       cast(cast(floor(l_extendedprice) as bigint) as varchar(20)) as estimated_reads
from lineitem join part on l_partkey = p_partkey""",
    "stg_marker_rel_ab_w_read_stats": """
select sample_id, clade_name, clade_taxid,
       try_cast(relative_abundance as double) as relative_abundance,
       try_cast(nullif(coverage, '-') as double) as coverage,
       try_cast(estimated_reads as bigint) as estimated_reads
from raw_rel_ab where sample_id is not null""",
    "raw_unknown": """
select md5(cast(s_suppkey as varchar(20))) as sample_id,
       concat('UNKNOWN_', cast(s_nationkey as varchar(20))) as clade_name,
       cast(s_nationkey as varchar(20)) as ncbi_tax_id,
       case when s_nationkey = 3 then '-'
            else cast(s_nationkey * 4 as varchar(20)) end as relative_abundance
from supplier""",
    "stg_metaphlan_unknown_list": """
select sample_id, clade_name, ncbi_tax_id,
       try_cast(relative_abundance as double) as relative_abundance
from raw_unknown where sample_id is not null""",
    "stg_metaphlan_viruses_list": """
select md5(cast(user_id as varchar(20))) as sample_id,
       concat('vg', cast(event_id % 97 as varchar(20))) as mv_group_cluster,
       concat('genome_', cast(event_id as varchar(20))) as genome_name,
       1000 + event_id % 50000 as length,
       value / 1000 as breadth_of_coverage,
       event_id % 1000 as mapping_reads_count,
       value as rpkm,
       value / 10 as depth_of_coverage_mean,
       value / 20 as depth_of_coverage_median,
       case when event_id % 3 = 0 then 'unknown' else 'known' end as mv_group_type,
       event_type as assigned_taxonomy,
       concat('g', cast(event_id % 13 as varchar(20))) as first_genome_in_cluster,
       props as other_genomes_in_cluster
from events""",
    "raw_accessions": """
select concat('ERR', cast(1000000 + o_orderkey as varchar(20))) as Accession,
       concat('ERA', cast(o_custkey as varchar(20))) as Submission,
       case when o_orderstatus = 'P' then '-' else o_orderstatus end as Status,
       case when o_custkey % 3 = 0 then '' else concat('the "C", ', cast(o_custkey as varchar(20))) end as Center,
       cast(o_custkey as varchar(20)) as Spots
from orders""",
    "src_sra_accessions": """
select Accession, Submission, nullif(Status, '-') as Status, Center, cast(Spots as bigint) as Spots
from raw_accessions""",
}

# The same datasets by supplier: what the raw runs hold.
for _name in ("stg_marker_abundance", "stg_marker_presence", "raw_rel_ab", "stg_marker_rel_ab_w_read_stats"):
    VIEWS[f"run_{_name}"] = VIEWS[_name].replace("l_orderkey", "l_suppkey").replace("from raw_rel_ab", "from run_raw_rel_ab")

DEPENDS = {
    "run_stg_marker_rel_ab_w_read_stats": ["run_raw_rel_ab"],
    "stg_marker_rel_ab_w_read_stats": ["raw_rel_ab"],
    "stg_metaphlan_unknown_list": ["raw_unknown"],
    "src_sra_accessions": ["raw_accessions"],
}


def with_views(body: str, *names: str) -> str:
    """``WITH <views> <body>`` with dependencies first, each view once."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in order)
    return f"with {ctes}\n{body.strip()}"
