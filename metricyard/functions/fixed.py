"""Fixed values that must equal the behaviour being reproduced.

FIXED VALUES -- these lists and tables are data, stated plainly and in their
natural order. They are small dimensions with a size fixed by the literals
below (never by the data): the jobs compile them into CASE expressions
(log rules, instrument rules) or broadcast them (the routing table).
"""

# FIXED VALUES: spellings of a missing value.
MISSING_TOKENS = ("", "null", "nan", "n.a.")            # is_missing (F9), compared lower-case
DROP_VALUE_TOKENS = ("nan", "null", "n.a.")             # short-read rows removed (F7)
NULLIFY_VALUE_TOKENS = ("nan", "n.a", "n.a.")           # long-read values kept as NULL (F8)
TBD_TOKEN = "!!!TBD!!!"                                 # placeholder flowcell (S9)

# FIXED VALUES: hidden per-project input files.
SETTINGS_FILE = ".settings.json"
ONT_INSTRUMENT_FILE = ".qifa.ont.json"

# FIXED VALUES: metadata placed before a short-read report's own columns (F1).
SHORT_READ_META = (
    "Investigator_Folder", "Project_ID", "Project_run_type", "Release_Date", "RunID",
    "InstrumentID", "FlowcellID", "Lane", "ProjStatus",
)
# FIXED VALUES: lane metrics appended after a short-read report's columns (F1), and the
# run-summary lane-block columns they come from, in the same order.
LANE_METRIC_NAMES = (
    "Cluster_PF_PCT", "Reads_Cluster_number_Mb", "Reads_Cluster_number_PF_Mb",
    "Q30_or_higher_PCT", "Yield_Gb", "Aligned_PhiX_PCT", "Error_rate_PhiX_alignment",
)
LANE_BLOCK_COLUMNS = ("ClusterPF", "Reads", "ReadsPF", "%>=Q30", "Yield", "Aligned", "Error")
LANE_BLOCK_START = "Cluster PF"
LANE_BLOCK_STOP = "Read 2 (I)"

# FIXED VALUES: short-read long table (15 text columns; key = all but ProjStatus).
SHORT_READ_COLUMNS = (
    "Investigator_Folder", "Project_ID", "Project_run_type", "Release_Date", "RunID",
    "InstrumentID", "FlowcellID", "Lane", "ProjStatus", "GT_QC_Sample_ID", "Sample_Name",
    "Species", "name", "value", "Application",
)
SHORT_READ_KEY = tuple(c for c in SHORT_READ_COLUMNS if c != "ProjStatus")

# FIXED VALUES: long-read base columns (PacBio and ONT tables).
LONG_READ_META = (
    "Investigator_Folder", "Project_ID", "Project_run_type", "Release_Date", "InstrumentID",
    "Species", "ProjStatus",
)
LONG_READ_BASE = LONG_READ_META + ("Application",)

# FIXED VALUES: short-read pivot anchor and report header markers.
PIVOT_ANCHOR = "Reads_Total"
SHORT_READ_MARKER = "GT_QC_Sample_ID"
LONG_READ_MARKERS = ("Sample_ID", "Sample Name", "Sample_Name")
SPECIES_ID_COLUMNS_RE = r"^(GT_QC_Sample_ID|Sample_Name|Domain[1-4]|Species[1-5])$"
SPECIES_LOOKUP_RE = r"^(Domain[1-4]|Species[1-5])$"
SPECIES_MISSING_WIDTH = 9

# FIXED VALUES: numeric long-read columns that stay identifiers (R2).
LONG_READ_ID_EXCEPTIONS = ("Plate_Number", "SMRT_Cell_Lot_Number", "Movie_Time_hours", "Instrument_SN")

# FIXED VALUES: PacBio report columns that are dropped (F3), after C3 renaming.
PACBIO_DROPPED_COLUMNS = (
    "Sample_Comment", "Sample_Summary", "Sample_Well", "DNA_Control_Complex", "Template_Prep_Kit",
    "Binding_Kit", "Sequencing_Kit", "Immobilization_time__hours_", "Pre-Extension_Time__hours_",
    "Status", "Adapter_Dimer", "Short_Insert", "Run_Comments", "Experiment_Name", "Experiment_ID",
    "Run_Start", "Run_Complete", "Transfer_Complete", "Run_Description", "Instrument",
    "Instrument_Control_SW_Version", "Primary_Analysis_Version", "Instrument_Chemistry_Bundle_Version",
    "Instrument_SN",
)

# FIXED VALUES: PacBio attribute reports (S10): metric name -> attribute id.
RAW_DATA_ATTRIBUTES = (
    ("Polymerase_Reads_raw", "raw_data_report.nreads"),
    ("Polymerase_Read_Bases_raw", "raw_data_report.nbases"),
    ("Polymerase_RL_N50_raw", "raw_data_report.read_n50"),
    ("Polymerase_RL_longestSubread_mean_raw", "raw_data_report.insert_length"),
    ("Polymerase_RL_longestSubread_N50_raw", "raw_data_report.insert_n50"),
    ("Unique_Molecular_Yield", "raw_data_report.unique_molecular_yield"),
    ("Local_Base_Rate", "raw_data_report.local_base_rate_median"),
)
CCS_ATTRIBUTES = (
    ("HiFi_reads_ccs_raw", "ccs2.number_of_ccs_reads"),
    ("HiFi_reads_yield_ccs_raw", "ccs2.total_number_of_ccs_bases"),
    ("HiFi_readlength_ccs_raw_mean", "ccs2.mean_ccs_readlength"),
    ("HiFi_readlength_median_bp_ccs_raw", "ccs2.median_ccs_readlength"),
    ("HiFi_readlength_N50_bp_ccs_raw", "ccs2.ccs_readlength_n50"),
    ("Q30_base_PCT_ccs_raw", "ccs2.percent_ccs_bases_q30"),
    ("HiFi_Number_of_Passes_mean_ccs_raw", "ccs2.mean_npasses"),
    ("Missing_adapters_PCT_ccs_raw", "ccs2.percent_missing_adapters"),
)
FRACTION_TO_PERCENT = ("Q30_base_PCT_ccs_raw", "Missing_adapters_PCT_ccs_raw")

# FIXED VALUES: applications whose folders are also found by their settings.
SETTINGS_APPLICATIONS = ("PacBio", "ONT")

# FIXED VALUES: routing of settings `application` values to QC pipelines (F13), case-sensitive.
ROUTING = (
    ("atacseq", ("ATACSeq", "ATAC")),
    ("chic", ("Other",)),
    ("hic", ("HiC",)),
    ("ctp", ("PDX-WGS",)),
    ("pdxrnaseqR2", ("cellranger",)),
    ("rnaseq", ("mRNA", "Total-RNA")),
    ("rrbs", ("RRBS",)),
    ("wgbs", ("WGBS",)),
    ("chipseq", ("ChiP", "ChIPSeq")),
    ("pdxrnaseq", ("PDX-mRNA", "pdxrnaseq")),
    ("pdxwgs", ("PDX-WGS",)),
    ("rnaseqR2", ("cellranger",)),
    ("wes", ("WES",)),
    ("wgs", ("WGS", "ChIA-PET")),
    ("basic", ("Amplicon", "Other")),
    ("ONT", ("ONT",)),
    ("PacBio", ("PacBio",)),
)

# FIXED VALUES: instrument rules (C9): first substring that hits gives the id.
PACBIO_INSTRUMENTS = (
    ("84148", "CT_Revio_84148"),
    ("SQ65119", "CT_Sequel_SQ65119"),
    ("64119", "CT_Sequel_SQ65119"),
    ("SQ65039", "CT_Sequel_SQ65039"),
    ("r64039", "CT_Sequel_SQ65039"),
)
ONT_INSTRUMENTS = (
    ("GXB02036", "CT_GridIONX5_GXB02036"),
    ("PCA100115", "CT_PromethION_PCA100115"),
    ("GXB03074", "BH_GridIONX5_GXB03074"),
    ("P2S-01535", "BH_P2_Solo_P2S-01535"),
    ("GXB01025", "CT_GridIONX5_GXB01025"),
    ("GXB01102", "CT_GridIONX5_GXB01102"),
    ("GXB01186", "CT_GridIONX5_GXB01186"),
    ("PC24B149", "CT_PromethION_PC24B149"),
    ("PCT0053", "CT_PromethION_PCT0053"),
)

# FIXED VALUES: species spellings (C8); substring, every hit, case-sensitive.
SPECIES_REWRITES = (
    ("homo sapiens|Human|human", "Homo sapiens"),
    ("marmoset", "Callithrix jacchus"),
)

# FIXED VALUES: tool-log triage (L1). A log is `<project>_QCreport.<pipeline>[.<stage>].log`;
# no stage suffix means the "run" log. Rules per stage in the order they are tried; the
# first pattern found in a file is its error class.
LOG_STAGES = ("run", "package", "release", "gather")
LOG_RULES = (
    ("run", "Unrecognized platform by QiFa"),
    ("run", "Program aborted"),
    ("run", "ERROR: Please complete basic QC before"),
    ("run", "0 .gz file(s) found"),
    ("run", "ERROR: loadQCParametersSetting organism"),
    ("package", "Program aborted"),
    ("release", "Program aborted"),
    ("gather", "!!!WARNING!!!"),
    ("gather", "ERROR: Could not locate output from QC pipeline"),
)
# Marker that opens a report block in a log; blocks end at a line holding "##" (L3, W5).
BLOCK_MARKERS = ("!!!WARNING!!!", "Report @")
REPORT_BLOCK_STOP = "##"
INTERNAL_LINE = "Internal"
RELEASE_PATH_LABEL = "INFO: Release path ="
# Stage-status markers in gather logs (L2), checked in this order.
STATUS_MARKERS = (
    ("failed", "job(s) failed"),
    ("incomplete", "qc job submission for all sample"),
    ("gathered", "Please proceed to report result"),
)

# FIXED VALUES: FASTQ read tags counted in a delivery manifest.
READ_TAGS = ("R1_", "R2_", "R3_", "I1_", "I2_")
UNDETERMINED = "Undetermined"

# FIXED VALUES: header word that is never a group name.
GROUP_HEADER_WORD = "Investigator_Folder"

# FIXED VALUES: release-date text formats tried in order.
RELEASE_DATE_FORMATS = (
    "yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd", "MM/dd/yyyy", "M/d/yyyy", "dd-MMM-yyyy",
    "MMM d yyyy", "MMMM d yyyy", "MMM d, yyyy", "MMMM d, yyyy", "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
)

# FIXED VALUES: cadences (T4, T5, T8); defaults of parameters.
ARCHIVE_RESCAN_DAYS = 5
LEDGER_RESET_DAYS = 10
BACKUP_RETENTION_DAYS = 10

# FIXED VALUES: sequencing_metrics typed schema.
SEQUENCING_SCHEMA = (
    ("Month", "int"), ("Year", "int"), ("Project", "string"), ("Site", "string"),
    ("InstrumentID", "string"), ("RunFolder", "string"), ("groupFolder", "string"),
    ("Application", "string"), ("FullPath", "string"), ("Platform", "string"),
    ("Reads", "bigint"), ("Bases", "bigint"), ("Bytes", "bigint"),
    ("DeliveryDirectory", "string"), ("SampleSize", "int"), ("PolymeraseReadLength_bp_Mean", "double"),
)

# FIXED VALUES: replacements in report headers, in this order.
HEADER_REPLACEMENTS = ((">=", "_GE_"), ("<=", "_LE_"), (">", "_GT_"), ("<", "_LT_"), ("%", "PCT"), (":", ""))

# FIXED VALUES: number patterns.
NUMERIC_PATTERNS = {"decimal": r"^[0-9]+(\.[0-9]+)?$", "sci": r"^[-+]?[0-9]+([.][0-9]+)?([eE][-+]?[0-9]+)?$", "digits": r"^[0-9]+$"}

# FIXED VALUES: names of the run files beside a report.
SUMMARY_DRAFT, SUMMARY_FINAL, RUN_INFO = "Run_Metric_Summary.draft.csv", "Run_Metric_Summary.csv", "RunInfo.xml"
REPORT_SUFFIX, SPECIES_SUFFIX = "_QCreport.{application}.csv", "_QCreport.speciesid.csv"
