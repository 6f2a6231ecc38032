"""Hand-derived results on small texts."""

import pytest
from pyspark.sql import functions as F

from locusframe.operators import align, conservation, convert, features, intervals, quality, smprot, variants
from locusframe.sources import alignments, annotation, lines as L, sequences, tables, vcf

GTF = "\n".join("\t".join(r) for r in [
    ("chr7", "own", "gene", "1001", "1300", ".", "-", ".", 'gene_id "GA"; gene_type "lncRNA";'),
    ("chr7", "own", "transcript", "1001", "1300", ".", "-", ".", 'gene_id "GA"; transcript_id "GA.2"; gene_type "lncRNA"; transcript_type "lncRNA";'),
    ("chr7", "own", "exon", "1211", "1300", ".", "-", ".", 'gene_id "GA"; transcript_id "GA.2"; exon_number "1";'),
    ("chr7", "own", "exon", "1001", "1055", ".", "-", ".", 'gene_id "GA"; transcript_id "GA.2"; exon_number "2";'),
])
VCF = "\n".join([
    "##fileformat=VCFv4.3", '##INFO=<ID=CLNSIG,Number=.,Type=String,Description="label">', "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"]),
    "\t".join(["chr7", "1220", "v70", "C", "T", "40", ".", "CLNSIG=Pathogenic"]), "\t".join(["chr7", "1040", "v71", "GCC", "G", "41", ".", "CLNSIG=Benign"]),
])


def test_features_and_clinvar(lines):
    feats = features.extract_features(annotation.parse_annotation(lines(GTF)))
    got = {(r.feature_type, r.feature_id, r.start, r.end, r.gene_type) for r in feats.collect()}
    # types of the intron come from the last record of the transcript, which states none
    assert got == {("gene", "GA", 1000, 1300, "lncRNA"), ("transcript", "GA.2", 1000, 1300, "lncRNA"), ("exon", "GA.2:exon1", 1210, 1300, "NA"),
                   ("exon", "GA.2:exon2", 1000, 1055, "NA"), ("intron", "GA.2:intron1", 1055, 1210, "NA")}
    kept = variants.clinvar_filter(vcf.parse_vcf(lines(VCF)))
    ann = variants.annotate_clinvar(feats, kept)
    rows = sorted(tuple(r) for r in ann.select("feature_id", "start", "end", "variant_id", "variant_name", "clinical_labels", "allele_id").collect())
    assert rows == [("GA.2:exon1", 1211, 1300, "v70", "NC_000007.14:g.1220C>T", "Pathogenic", "NA"), ("GA.2:exon2", 1001, 1055, "v71", "NC_000007.14:g.1040GCC>G", "Benign", "NA")]
    summary = {r.label: r["count"] for r in variants.summarize_annotations(ann).collect()}
    assert summary == {"ALL": 2, "Pathogenic": 1, "Benign": 1, "Affects": 0, "Drug response": 0, "Protective": 0, "Risk factor": 0}


def test_overlap_sample(spark):
    a = spark.createDataFrame([("chr1", 0, 10), ("chr1", 20, 30)], "chrom string, start bigint, end bigint")
    b = spark.createDataFrame([("chr1", 5, 12), ("chr1", 25, 27), ("chr1", 10, 20)], "chrom string, start bigint, end bigint")
    assert sorted(tuple(r) for r in intervals.interval_join(a, b).collect()) == [("chr1", 0, 10, 5, 12), ("chr1", 20, 30, 25, 27)]


def test_cosmic_gwas_thresholds(spark):
    c = spark.createDataFrame([("1", "5", "A", "T", "c1", "0.9", ""), ("1", "6", "", "", "", "nan", "d"), ("1", "7", "A", "T", "c3", "0.7", "d")],
                              "chrom string, pos string, ref string, alt string, cosmic_id string, fathmm_mkl_score string, disease_name string")
    assert sorted(r.cosmic_id for r in variants.cosmic_filter(c).collect()) == ["c1", "chr1:6:N:."]
    g = spark.createDataFrame([("1", "5", "rs1", "1e-9", "t"), ("1", "6", "rs2", "nan", "t"), ("1", "7", "rs3", "5e-8", "t")],
                              "chrom string, pos string, variant_id string, p_value string, trait_name string")
    assert sorted(r.variant_id for r in variants.gwas_filter(g).collect()) == ["rs1", "rs2"]


def test_aliases_from_file(spark, tmp_path):
    p = tmp_path / "c.tsv"
    p.write_text("Chromosome\tGENOME-POSITION\tref\talt\tMutation_ID\tFATHMM_MKL\thistology\n1\t10\tA\tG\tcosm1\t0.9\tglioma\n")
    assert [tuple(r) for r in variants.cosmic_filter(tables.scan_cosmic(spark, str(p))).select("chrom", "start", "cosmic_id", "disease_name").collect()] == [
        ("chr1", 9, "cosm1", "glioma")]
    s1, s2 = tmp_path / "a.tsv", tmp_path / "b.txt"
    s1.write_text("protein_id\tchrom\tstart\tend\np1\tchr1\t1\t30\n")
    s2.write_text("SmProtID chr begin stop\np2 2 5 9\n")
    multi = tables.scan_smprot(spark, [str(s1), str(s2)])
    assert sorted((r.protein_id, r.origin_file) for r in multi.collect()) == [("p1", "a.tsv"), ("p2", "b.txt")]
    s3 = tmp_path / "c.tsv"
    s3.write_text('End\tStart\t"Chr"\tID\n\n"9"\t"7"\t"chr""3"\tp3\n')
    assert sorted((r.protein_id, r.chrom, r.start) for r in tables.scan_smprot(spark, [str(s1), str(s2), str(s3)]).collect()) == [("p1", "chr1", "1"), ("p2", "2", "5"), ("p3", 'chr"3', "7")]
    (tmp_path / "bad.tsv").write_text("protein_id\tchrom\np\tchr1\n")
    with pytest.raises(ValueError, match="start, end"):
        tables.scan_smprot(spark, [str(s1), str(tmp_path / "bad.tsv")])
    plan = tables.parse_smprot(L.read_lines(spark, [str(s1), str(s2), str(s3)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # the rows and the headers, however many files
    feats = spark.createDataFrame([("chr1", 0, 40, "exon", "e", "g", "tx1", "+", "NA", "NA")], ",".join(
        f"{c} {'bigint' if c in ('start', 'end') else 'string'}" for c in features.FEATURE_COLUMNS))
    placed = smprot.place_proteins(feats, smprot.smprot_filter(multi))
    assert [(r.protein_id, r.start, r.end, r.transcript_id) for r in placed.collect()] == [("p1", 1, 30, "tx1")]


def test_file_order_and_line_numbers(spark, tmp_path):
    p = tmp_path / "big.txt"
    p.write_text("\n".join(f"row{i}" for i in range(5000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = L.with_line_numbers(L.read_lines(spark, str(p))).orderBy("ord").select("value", "line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.value, r.line_no) for r in got] == [(f"row{i}", i + 1) for i in range(5000)]


def test_fasta_file(spark, tmp_path):
    p = tmp_path / "s.fa"
    p.write_text(">a one\nACGT\nAC\n>b\nTT\n>a two\nGG\n")
    assert {r.id: r.seq for r in sequences.scan_fasta(spark, str(p)).collect()} == {"a": "GG", "b": "TT"}
    chunks = sequences.scan_genome(spark, str(p)).collect()
    assert sorted((r.chrom, r.start, r.bases) for r in chunks) == [("a", 0, "ACGT"), ("a", 0, "GG"), ("a", 4, "AC"), ("b", 0, "TT")]


def test_psl_and_chain_checks(lines):
    psl = "\n".join(["psLayout version 3", "-----", "90\t6\t2\t2\t1\t20\t1\t50\t+\tp\t300\t30\t150\tchr7\t5000\t200\t350\t2\t40,60,\t30,90,\t200,290,"])
    assert quality.check_psl(lines(psl)).passed()
    bad = psl.replace("90\t6", "91\t6")
    assert not quality.check_psl(lines(bad)).passed()
    chain = "chain 25 chr7 5000 + 100 260 n7 4000 + 300 450 4\n80\t30\t20\n50\n"
    assert quality.check_chain(lines(chain)).passed()
    assert [r.rule for r in quality.check_chain(lines(chain.replace("\n50\n", "\n51\n"))).issues().orderBy("rule").collect()] == [
        "query blocks differ from the span", "target blocks differ from the span"]
    lifted = align.liftover(convert_bed(lines, "chr7\t110\t130\nchr7\t170\t220\nchr2\t1\t5"), alignments.parse_chain_blocks(lines(chain)), 0.95)
    assert sorted((r.chrom, r.start, r.fate, r.new_start) for r in lifted.collect()) == [("chr2", 1, "deleted", None), ("chr7", 110, "mapped", 310), ("chr7", 170, "partial", None)]


def convert_bed(lines, text):
    return annotation.parse_bed(lines(text)).select("chrom", "start", "end")


def test_bedmethyl_needs_known_layout(lines):
    row = "chr7\t40\t41\tm\t8\t-\t40\t41\t0,0,0\t8\t25.00\t2"
    check = quality.check_bedmethyl(lines(row))
    assert not check.passed()
    assert convert.bedmethyl_to_bed(annotation.parse_bed(lines(row)), coverage=True).first().coverage == "8"


def test_conservation_chain(spark):
    def table(rows, schema):
        return spark.createDataFrame(rows, schema)

    seq = "species string, mode string, segment_id string, seq string"
    q = table([("rat", "lnc", "k9_1", "GGCATTAGCCAT"), ("rat", "lnc", "k9_2", "TTGACA")], seq)
    t = table([("rat", "lnc", "k9_1", "GGCATTAGCGTT"), ("rat", "lnc", "k9_2", "TTGACT")], seq)
    blk = "species string, mode string, ids string, start bigint, end bigint, strand string, sizes array<bigint>, starts array<bigint>"
    b = table([("rat", "lnc", "k9_1", 50, 62, "-", [12], [0]), ("rat", "lnc", "k9_2", 80, 86, "-", [6], [0])], blk)
    e = table([("rat", "lnc", "k9", 45, 95, "-", [20, 20], [0, 30])], blk)
    sc = conservation.segment_scores(q, t)
    assert conservation.duplicate_segments(sc, b).count() == 0
    r = conservation.aggregate_groups(sc, conservation.nearby_groups(sc, b), b, e).first()
    assert (r.grouped_id, r.mapped_length, r.matched_length, round(r.match_ratio, 4), r.true_mapped_length, r.exon_covered, r.exon_counts) == ("k9_1", 18, 15, 0.8333, 18, "1,2", 2)
    assert conservation.pair_problems(q, t).count() == 0


def test_contig_and_track_exports(spark, lines, tmp_path):
    from locusframe.sources import sinks

    rec = vcf.parse_vcf(lines(VCF))
    sinks.split_by_contig(rec, str(tmp_path / "split"))
    assert spark.read.text(str(tmp_path / "split" / "part=chr7")).count() == 2
    head = [line for line in VCF.split("\n") if line.startswith("#")]
    sinks.split_by_contig(rec, str(tmp_path / "whole"), header=head)
    back = vcf.scan_vcf(spark, str(tmp_path / "whole" / "part=chr7"))
    assert sorted((r.pos, r.ref, r.info) for r in back.collect()) == [(1040, "GCC", "CLNSIG=Benign"), (1220, "C", "CLNSIG=Pathogenic")]
    sinks.write_vcf(rec, lines(VCF), str(tmp_path / "all"))
    text = [r.value for r in spark.read.text(str(tmp_path / "all")).collect()]
    assert text[:3] == head and sorted(text[3:]) == sorted(VCF.split("\n")[3:])
    assert sinks.track_line("n", colour="0,0,178") == 'track name="n" color=0,0,178'
    try:
        sinks.track_line("n", colour="0,0,300")
    except ValueError:
        pass
    else:
        raise AssertionError("colour above 255 accepted")
    assert variants.vcf_statistics(rec).where("metric = 'ts_tv_ratio'").first().value == "NA"
    assert rec.select(F.max("pos")).first()[0] == 1220


def test_alleles_are_cut_by_the_header_of_their_own_file(spark):
    meta = spark.createDataFrame([("p", 1, "INFO", "X", "1"), ("p", 2, "INFO", "X", "A"), ("q", 1, "INFO", "X", "R"), ("q", 2, "FORMAT", "PL", "G")], "path string, ord long, kind string, id string, number string")
    row = lambda path, alts, info, formats, samples: (path, 9, "1", 5, ".", "A", alts, ".", ".", info, formats, samples)
    schema = ("path string, ord long, chrom string, pos long, id string, ref string, alts array<string>, qual string, filter string, info string, "
              "formats array<string>, samples array<string>")
    vcf = spark.createDataFrame([
        row("p", ["C", "G"], "X=1,2;F", [], []), row("q", ["C", "G"], "X=0,1,2", ["GT", "PL"], ["1/2:0,1,2,3,4,5", "0|2:7,8"]),
        row("r", ["C", "G"], "X=1,2", [], []), row("q", ["T"], "X=0,1", ["GT"], ["1/1"])], schema)
    got = {(r.path, tuple(r.alts)): (r["info"], r.samples, r.kept_genotype_fields) for r in variants.normalize_alleles(vcf, meta).collect()}
    assert got == {
        ("p", ("C",)): ("X=1;F", [], 0), ("p", ("G",)): ("X=2;F", [], 0),
        ("q", ("C",)): ("X=0,1", ["1/.:0,1,2", "0|.:7,8"], 1), ("q", ("T",)): ("X=0,1", ["1/1"], 0),
        ("q", ("G",)): ("X=0,2", ["./1:0,3,5", "0|1:7,8"], 1),
        ("r", ("C",)): ("X=1", [], 0), ("r", ("G",)): ("X=2", [], 0)}
