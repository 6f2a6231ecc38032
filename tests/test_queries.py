"""Registered queries against their SQL at the smallest scale, a share per family."""

import os

import pytest

from oracle import compare, connect

SF = "/root/testdata/sf0.001"
NAMES = [
    "interval_overlap_join", "coverage_depth", "union_tracks", "extract_features", "extract_cds_utr", "bed_to_features", "spliced_sequences", "clinvar_filter",
    "summarize_clinvar", "annotate_gwas", "place_proteins_uniquely", "vcf_normalize_alleles", "vcf_statistics", "methylation_rank_statistics",
    "methylation_false_discovery", "predict_interactions", "experimental_gene_mirna_pairs", "group_statistics", "best_homologs", "gene_age", "liftover_intervals",
    "psl_map_through_chains", "sam_to_bed12", "transcripts_to_bed12", "scan_wig", "check_annotation", "check_vcf", "check_bedgraph_order", "bed_error_messages", "step_status",
    "scan_header_tables", "scan_smprot_files", "written_table", "vcf_split_files", "scan_plain_table", "scan_fasta", "mature_mirnas", "scan_gene_regions", "scan_block_table",
]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    from locusframe.plans.registry import all_queries

    q = all_queries()[name]
    assert compare(q(spark, SF), connect(SF), q.oracle) == ""
