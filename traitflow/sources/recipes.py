"""Per-source ingest recipes (data only; ``ingest.ingest`` runs them).

The literal values, patterns, prefixes and formats below are fixed values: they must equal
the modelled pipeline's rules for each extract so that the same rows survive.
Date formats are written as Spark datetime patterns.
"""

from __future__ import annotations

from traitflow.sources.ingest import Recipe

# ---------------------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------------------
PRIMARY_CARE_KEYS = [
    "2022_04_Discovery_path", "2022_12_Discovery_path", "2023_03_Discovery_path",
    "2023_11_Discovery_path", "2024_07_Discovery_path", "2024_12_Discovery_path",
]
NDA_KEY = "2024_10_NHSD_NHSE_NDA_path"
BARTS_KEYS = [
    "2021_04_Barts_path", "2022_03_Barts_path", "2023_05_Barts_path", "2023_05_Barts_measurements",
    "2023_12_Barts_path", "2023_12_Barts_measurements", "2024_09_Barts_path", "2024_09_Barts_measurements",
]
BRADFORD_KEYS = [
    "2022_06_Bradford_measurements", "2023_05_Bradford_path", "2024_12_Bradford_measurements",
    "2024_12_Bradford_path",
]
# Dedup survivor order when the same reading comes from several extracts.
PROVENANCE_ORDER = PRIMARY_CARE_KEYS + [NDA_KEY] + BARTS_KEYS + BRADFORD_KEYS
# Units filled in on the merged readings when missing: (exact term, unit).
COMBO_UNIT_FILLS = [("POCT Blood Ketones", "millimol/L")]

NDA_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]"

BRADFORD_PATH_2023_05_NE = ["NA", "N/A", "NA;INS", "Error", "High", ";INS", "Negative", "TNP", "See Film Comms."]
BRADFORD_PATH_2023_05_REGEX = ["(?i)detected", "(?i)positive", "(?i)see comment", "(?i)unable to process"]
BRADFORD_PATH_2023_05_PREFIXES = [
    "less thn ", "Less thn ", "Lss thn ", "Less thnn ", "Less than ", "Less Thn ", "Greater than ",
    "Grtr thn ", " ", "<", ">",
]

BRADFORD_MEAS_2022_06_UNITS = [("weight", "kg"), ("height", "cm"), ("index", "kg/m2")]
BRADFORD_MEAS_2024_12_UNITS = [("weight", "kg"), ("height", "cm"), ("index", "kg/m^2"),
                               ("pressure", "mmHg"), ("glucose", "mmol/L")]
BRADFORD_MEAS_2024_12_REGEX = [" - ", "[a-zA-Z/]"]

BARTS_2021_04_PROBLEM_FILES = [
    "2021_01_25_pseudoNHS_uniq.csv", "Haemoglobin_April2021.csv", "LipoproteinA_April2021.csv",
    "MCH_April2021.csv", "Progesterone_April2021.csv", "RDW_April2021.csv",
    "AntiMullerianHormone_April2021.csv", "Islet Antibody.csv",
]
BARTS_2021_04_COLUMNS = ["pseudo_nhs_number", "column_2", "original_term", "test_date", "result",
                         "result_value_units"]
BARTS_2021_04_NE = ["1429 at 10.40 on 28/11/14.", "08/01/2014"]
BARTS_2021_04_PREFIXES = ["<", ">", " "]

BARTS_2022_03_COLUMNS = ["PseudoNHSnumber", "ReportDate", "TestDesc", "ResultTxt", "ResultUnit"]
BARTS_2022_03_REGEX = [r"[a-zA-Z]", r"\d/\d", r"\d{2}:\d{2}", r"\++", r"-+", r"\*+", r"\?", r"\(", r"\d \d"]
BARTS_2022_03_ENDS = [" -"]
BARTS_2022_03_STARTS = [" "]
BARTS_2022_03_NE = [".", "#", "]", "*", ":", "?", ". .", ". . . . .", "0.18*", "22.01.15; 1800"]
BARTS_2022_03_PREFIXES = ["< ", "<", ">"]

BARTS_MEAS_2023_05_REGEX = [r"^\..*?"]
BARTS_MEAS_2023_05_SUFFIXES = ["cm"]
BARTS_MEAS_TYPO = (r"3\.6\.1", "36.1")

BRADFORD_PATH_2024_12_REGEX = ["-No evidence of past infection."]
BRADFORD_PATH_2024_12_PREFIXES = [
    "less thn ", "Less thn ", "Less than", "Less Thn ", "Greater than ", "Grtr thn ", " ", "<", ">", "NA",
    "N/A", "Error", "High", ";INS", "Negative", "Positive", "POSITIVE", "TNP", "See Film Comms.",
]
BRADFORD_PATH_2024_12_REPLACE_FIRST = [
    ("(?i)detected", ""), ("(?i)see comment", ""), ("(?i)unable to process", ""), ("not ", ""), ("Not ", ""),
    ("NOT ", ""),
]

BARTS_PATH_2024_09_STEP1_REGEX = ["[a-zA-Z]"]
BARTS_PATH_2024_09_STEP1_NE = ["-", "-"]
BARTS_PATH_2024_09_STEP2_NE = [
    "**", "***", "****", "*****", "*", "* -", "-", "--", "- -", "-  -", "- .", ". .", ". . .", "----", "+", "+++",
    "++++", "#", "`", "-.", ".....", ". . . . .", ",.", "#", "`", ".", ".", ".....", ",.", "?", ",", ":", "]", "{.}",
]
BARTS_PATH_2024_09_STEP3_NE = [
    ">1/640", "28.8 28.8", "28.3 28.3", "1:8", "2+48", "2+0", "{4}", "1:32", "{88}", "3-", "{93}", "(66", "1:32",
    "1:16", "106 - - - - - -",
]
BARTS_PATH_2024_09_STEP3_REGEX = [r"^\d+(\.\d+)? \d+(\.\d+)?$"]
BARTS_PATH_2024_09_LATER_REGEX = [
    [r"^\d{2}:\d{2}$"], [r"^\d*\s?-$"], [r"^\$|^\*|^\?"], [r"\*$"], [r"\d*\+$"], [r"\d+(\.\d+)?%$"],
    [r"/.*/", r"\d{2}\.\d{2}\.\d{2}; \d{4}"], [r"/"], [r"\d+-\d+"],
]
BARTS_PATH_2024_09_DATE_KEEP = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}"
BARTS_PATH_2024_09_STRIPS = [("strip_prefix", ["<", ">", "+-", "+/-"]), ("strip_suffix", ["cm"]),
                             ("strip_prefix", ["("]), ("strip_suffix", [")"]), ("strip_prefix", [" "])]

BARTS_PATH_2023_05_NE = [
    '**', '***', '****', '*', '* -', '-', '--', '- -', '-  -', '+', '++', '+++', '++++', '*115', '#', '/',
    '`', ',.', '.', '.....', 'n/r', 'na', 'n/a', 'NA', '?', ',', ':', ']', 'c', 'MK', 'B', 'P', 'ns', '1a',
    '1b', '3a', '3b', '3-', '64-', 'B2A2', 'B3A2', 'FM', 'UNS', '@unb', '@und', 'None', '2-5', '1:8', '1:16',
    '1:32', '4o', '*40', 'body', 'Body', '24hr', '24HR', 'KNIB', '64 -', '70)', '(70)', '(66', '*66', '*81',
    '*92', '*{88}', '*{94}', '5ml', 'Serum', ' Serum"', 'clumps', '"Regret', 'random', 'Random', 'RANDOM',
    'RAMDOM', 'Clumped', 'CLUMPED', 'deleted', 'DELETED', 'Pending', '24 hour',
    'Not requested. PLEASE NOTE - THIS IS AN AMENDED REPORT', 'No result available - see comment',
    'Not Calculated Units: mL/min/1.73sqm For Afro-Caribbean patients multiply eGFR by 1.21 Use with caution for adjusting drug dosage.',
    'Intrinsic Factor antibodies not tested as Gastric Parietal Cell antibody was negative. http://jcp.bmj.com/content/62/5/439.abstract',
    'Albumin Creatinine ratio within normal limits', 'Wrong patient bled. Suggest repeat.',
]
BARTS_PATH_2023_12_NE = [
    '**', '***', '****', '*****', '*', '* -', '-', '--', '- -', '-  -', '++++', '#', '`', '.....', ',.',
    'n/r', 'na', 'n/a', 'NA', '?', ',', ':', ']', 'c', 'MK', 'B', 'P', '1a', '1b', '3a', '3b', '3-', '64-',
    'B2A2', 'B3A2', 'FM', 'UNS', '@unb', '@und', 'None', '2-5', '1:8', '1:16', '1:32', '4o', '*40', 'body',
    'Body', '24hr', '24 hrs', '24HR', 'KNIB', '64 -', '70)', '(70)', '(66', 'other', 'Clear', 'rerun',
    'Venous', '{REPEAT}', 'deleted', 'DELETED', '09:00', '10:17', '10:38', '11:30', '16:00', '18:00',
    '21:00', '23:59', 'day 1', 'day 2', 'Day 2', 'DAY 2', 'day 3', 'Day 4', 'day 7', 'Day 8', 'Day 10',
    'day 17', 'day 21', 'Day 21', 'DAY 21', '0 min', '30 min', '60 min', '4 hrs', '7.5 hrs', '44285*',
    '20753*', '124 -', 'LCMSMS', '1.01 26', '1.20 15', '0.99 10', '0.99 11', '0.99 12', '1.00 10', '2.41 32',
    '0.95 14', '0.95 17', '1.05 9', '0.94 26', 'Add on', 'clumps', 'Clumped', '*Clumped', 'clumped',
    'Clumpled', 'no clot', 'No clot', 'NO CLOT', 'Pending', 'IgM only', '>1/640', '1/640', '1/160', 'Cloudy',
    'Pleural', 'ramdom', 'random', 'Random', 'RANDOM', 'Reject', 'normal', 'Normal', 'NORMAL', 'invalid',
    'Note Hb', 'reduced', 'Reduced', 'Unknown', 'DR req', '?on GCSF', 'MDS/MPN', 'Arterial', 'CAPASCIN',
    'Detected', 'negative', 'Negative', 'NEGATIVE', 'Neagtive', 'positive', 'Positive', 'POSITIVE',
    'No clot.', 'Obscured', 'See ADAL', 'Speckled', 'Stained', 'Pendings', 'Rejected', '33 hours',
    '09S00088662 Read code 43X4 Read code 43BA',
]
BARTS_PATH_2023_05_REGEX = ['^"', "(?i)insufficient", "(?i)unsuitable", "(?i)inadequately", "(?i)received"]
BARTS_PATH_2023_05_DATES = ["ReportDate", "Report", "RequestDate"]
BARTS_PATH_2023_05_PREFIXES = ["<", ">", "+-", "+/-"]
BARTS_PATH_2023_05_BRACES = (r"^\{(.*?)\}$", "$1")
BARTS_PATH_2023_05_SUFFIXES = [" -", '"', "%", " g/l"]

BARTS_PATH_2023_12_TABS = 16
BARTS_PATH_2023_12_REGEX = [
    "[a-zA-Z]",
    "^100-149 mIU/ml Low Level Antibody detected Low level VZV IgG detected For immunocompromised patients "
    "recently exposed to VZV",
    "(?i)unsuitable", "(?i)not been accepted", r"^\d{2}[A-Z]\d{8}", r"^\d+.*?\*\s\*\s",
    r"^\d{2}/\d{2}/\d{2,4}.? \d{2}:\d{2}$",
]
BARTS_PATH_2023_12_PREFIXES = ["<", ">", "+-", "+/-"]

BARTS_MEAS_2023_12_FIRST_REGEX = [r"\d:\d{16}:\d\.000000:\d{1,3}:0"]
BARTS_MEAS_2023_12_NE = ["06.01.2010", "10:00", "10%", "."]
BARTS_MEAS_2023_12_REGEX = [
    r"[\+\)a-zA-Z/\s]", r"\d{1,2}\.\d{1,2}\.\d{2,4}", r"\d{1,2}:\d{2}", r"^\d+(\.\d+)?%$", r"^\d+(\.\d+)?`$", r"`",
    r"=", r"^\d+:\d+$", r"^\.+$", r"\.:", r":!", r":", r";", r"_", r"#",
]
BARTS_MEAS_2023_12_NE_2 = ["?"]
BARTS_MEAS_2023_12_REGEX_2 = [r"\*", r"\..*\.", "'"]
BARTS_MEAS_2023_12_ENDS = ["&"]
BARTS_MEAS_2023_12_REGEX_3 = [r"^-+$", r"\d-+\d"]
BARTS_MEAS_2023_12_ENDS_2 = ["-"]
BARTS_MEAS_2023_12_REGEX_4 = [r"\\"]

BARTS_MEAS_COLUMNS_2024_09 = [
    "PseudoNHS_2024-07-10", "SystemLookup", "ClinicalSignificanceDate", "ResultNumeric", "EventResult",
    "UnitsCode", "UnitsDesc", "NormalCode", "NormalDesc", "LowValue", "HighValue", "EventText", "EventType",
    "EventParent",
]
BARTS_MEAS_TABS = 13
BARTS_MEAS_2024_09_UNITS_NE = ["0"]
BARTS_MEAS_2024_09_RESULT_NE = [".", ".2.2"]
BARTS_MEAS_2024_09_REGEX = [r"[\)a-zA-Z/\s-]"]
BARTS_MEAS_COMMA_TERM = "Child's Birth Weight (g)"
# ---------------------------------------------------------------------------------------


def primary_care(key: str) -> Recipe:
    return Recipe(
        key=key, source="primary_care", sep=",", null_values=("NULL", ""),
        rename={"clinical_effective_date": "test_date", "result_value": "result"},
        steps=[("not_null", ["test_date", "result", "result_value_units"])],
        date_format="yyyy-MM-dd")


def nda(measure: str) -> Recipe:
    spec = {
        "BMI": ("BMI_DATE", "BMI_VALUE", "Body Mass Index Measured", "kg/m2"),
        "CHOL": ("CHOLESTEROL_DATE", "CHOL_VALUE", "Serum total cholesterol level", "mmol/L"),
        "HBA1C": ("HBA1C_DATE", "HBA1C_MMOL_VALUE", "Haemoglobin A1c level", "mmol/mol"),
    }
    date_col, value_col, term, unit = spec[measure]
    return Recipe(
        key=NDA_KEY, source="primary_care", sep="|",
        rename={"STUDY_ID": "pseudo_nhs_number", date_col: "test_date", value_col: "result"},
        constants={"original_term": term, "result_value_units": unit},
        steps=[("not_null", ["result"])], date_format=NDA_DATE_FORMAT)


def nda_bp() -> Recipe:
    return Recipe(key=NDA_KEY, source="primary_care", sep="|",
                  rename={"STUDY_ID": "pseudo_nhs_number", "BP_Date": "test_date"},
                  unpivot={"DIASTOLIC_VALUE": "Diastolic arterial pressure",
                           "SYSTOLIC_VALUE": "Systolic arterial pressure"},
                  date_format=NDA_DATE_FORMAT)


def bradford_path_2023_05() -> Recipe:
    return Recipe(
        key="2023_05_Bradford_path", sep="\t",
        rename={"PseudoNHS_2023_04_24": "pseudo_nhs_number", "lab_test_performed_date": "test_date",
                "EVENT_DESCRIPTION": "original_term", "RESULT": "result", "RESULT_UNIT_DESC": "result_value_units"},
        steps=[("not_null", ["result"]),
               ("ne", "result", BRADFORD_PATH_2023_05_NE),
               ("regex_block", "result", BRADFORD_PATH_2023_05_REGEX),
               ("strip_prefix", "result", BRADFORD_PATH_2023_05_PREFIXES),
               ("nonempty", "result")],
        date_format="yyyy-MM-dd")


def bradford_meas_2022_06() -> Recipe:
    return Recipe(
        key="2022_06_Bradford_measurements", sep="\t",
        rename={"PseudoNHS": "pseudo_nhs_number", "date_of_measurement": "test_date",
                "EVENT_TITLE": "original_term", "EVENT_ANSWER": "result"},
        steps=[("unit_from_term", "original_term", BRADFORD_MEAS_2022_06_UNITS)],
        date_format="dd/MM/yyyy")


def bradford_meas_2024_12() -> Recipe:
    return Recipe(
        key="2024_12_Bradford_measurements", sep="\t",
        rename={"PseudoNHS_2024-07-10": "pseudo_nhs_number", "date_of_measurement": "test_date",
                "EVENT_TITLE": "original_term", "EVENT_ANSWER": "result"},
        steps=[("regex_block", "result", BRADFORD_MEAS_2024_12_REGEX),
               ("unit_from_term", "original_term", BRADFORD_MEAS_2024_12_UNITS)],
        date_format="yyyy-MM-dd")


def barts_path_2021_04() -> Recipe:
    return Recipe(
        key="2021_04_Barts_path", sep=",", null_values=("NULL", ""), header=True,
        columns=BARTS_2021_04_COLUMNS, file_col="file", exclude_files=BARTS_2021_04_PROBLEM_FILES,
        steps=[("ne", "result", BARTS_2021_04_NE),
               ("strip_prefix", "result", BARTS_2021_04_PREFIXES)],
        date_format="dd/MM/yyyy")


def barts_path_2022_03() -> Recipe:
    return Recipe(
        key="2022_03_Barts_path", sep=",", columns=BARTS_2022_03_COLUMNS,
        line_rules=[("drop_quoted", ",")],
        rename={"PseudoNHSnumber": "pseudo_nhs_number", "ReportDate": "test_date", "TestDesc": "original_term",
                "ResultTxt": "result", "ResultUnit": "result_value_units"},
        steps=[("regex_block", "result", BARTS_2022_03_REGEX),
               ("ends_block", "result", BARTS_2022_03_ENDS),
               ("starts_block", "result", BARTS_2022_03_STARTS),
               ("ne", "result", BARTS_2022_03_NE),
               ("strip_prefix", "result", BARTS_2022_03_PREFIXES)],
        date_format="yyyy-MM-dd HH:mm")


def barts_meas_2023_05() -> Recipe:
    return Recipe(
        key="2023_05_Barts_measurements", sep="\t",
        rename={"PseudoNHS_2023_04_24": "pseudo_nhs_number", "ClinicalSignificanceDate": "test_date",
                "EventType": "original_term", "EventResult": "result", "UnitsDesc": "result_value_units"},
        steps=[("regex_block", "result", BARTS_MEAS_2023_05_REGEX),
               ("strip_suffix", "result", BARTS_MEAS_2023_05_SUFFIXES),
               ("replace_first", "result", *BARTS_MEAS_TYPO)],
        clock12=True)


def bradford_path_2024_12() -> Recipe:
    return Recipe(
        key="2024_12_Bradford_path", sep="\t",
        rename={"PseudoNHS_2024-07-10": "pseudo_nhs_number", "lab_test_performed_date": "test_date",
                "EVENT_DESCRIPTION": "original_term", "RESULT": "result", "RESULT_UNIT_DESC": "result_value_units"},
        steps=[("regex_block", "result", BRADFORD_PATH_2024_12_REGEX),
               ("not_null", ["result"]),
               ("strip_prefix", "result", BRADFORD_PATH_2024_12_PREFIXES),
               *[("replace_first", "result", pat, rep) for pat, rep in BRADFORD_PATH_2024_12_REPLACE_FIRST],
               ("nonempty", "result")],
        date_format="yyyy-MM-dd")


def barts_meas_2024_09() -> Recipe:
    return Recipe(
        key="2024_09_Barts_measurements", sep="\t", columns=BARTS_MEAS_COLUMNS_2024_09,
        line_rules=[("width", BARTS_MEAS_TABS)],
        rename={"PseudoNHS_2024-07-10": "pseudo_nhs_number", "ClinicalSignificanceDate": "test_date",
                "EventType": "original_term", "EventResult": "result", "UnitsDesc": "result_value_units"},
        steps=[("ne", "result_value_units", BARTS_MEAS_2024_09_UNITS_NE),
               ("ne", "result", BARTS_MEAS_2024_09_RESULT_NE),
               ("regex_block", "result", BARTS_MEAS_2024_09_REGEX),
               ("value_repair", "result", BARTS_MEAS_COMMA_TERM, ","),
               ("replace_first", "result", *BARTS_MEAS_TYPO)],
        clock12=True)


def barts_path_2024_09() -> Recipe:
    return Recipe(
        key="2024_09_Barts_path", sep="\t", line_rules=[("strip_quotes",)],
        rename={"PseudoNHS_2024-07-10": "pseudo_nhs_number", "ReportDate": "test_date", "TestDesc": "original_term",
                "ResultTxt": "result", "ResultUnit": "result_value_units"},
        steps=[("regex_block", "result", BARTS_PATH_2024_09_STEP1_REGEX),
               ("ne", "result", BARTS_PATH_2024_09_STEP1_NE),
               ("ne", "result", BARTS_PATH_2024_09_STEP2_NE),
               ("ne", "result", BARTS_PATH_2024_09_STEP3_NE),
               ("regex_block", "result", BARTS_PATH_2024_09_STEP3_REGEX),
               *[("regex_block", "result", pats) for pats in BARTS_PATH_2024_09_LATER_REGEX],
               ("regex_keep", "test_date", BARTS_PATH_2024_09_DATE_KEEP),
               *[(kind, "result", vals) for kind, vals in BARTS_PATH_2024_09_STRIPS]],
        date_format="yyyy-MM-dd HH:mm")


def barts_path_2023_05() -> Recipe:
    return Recipe(
        key="2023_05_Barts_path", sep="\t", line_rules=[("drop_quoted", "\t")],
        rename={"PseudoNHS_2023_04_24": "pseudo_nhs_number", "TestDesc": "original_term", "ResultTxt": "result",
                "ResultUnit": "result_value_units"},
        steps=[("ne", "result", BARTS_PATH_2023_05_NE),
               ("regex_block", "result", BARTS_PATH_2023_05_REGEX),
               ("strip_prefix", "result", BARTS_PATH_2023_05_PREFIXES),
               ("replace_first", "result", *BARTS_PATH_2023_05_BRACES),
               ("strip_prefix", "result", [" "]),
               ("strip_suffix", "result", BARTS_PATH_2023_05_SUFFIXES)],
        date_candidates=BARTS_PATH_2023_05_DATES, date_format="yyyy-MM-dd HH:mm", result_strict=False)


def barts_path_2023_12() -> Recipe:
    return Recipe(
        key="2023_12_Barts_path", sep="\t", line_rules=[("width", BARTS_PATH_2023_12_TABS)],
        rename={"PseudoNHS_2023_11_08": "pseudo_nhs_number", "ReportDate": "test_date", "TestDesc": "original_term",
                "ResultTxt": "result", "ResultUnit": "result_value_units"},
        steps=[("regex_block", "result", BARTS_PATH_2023_12_REGEX),
               ("ne", "result", BARTS_PATH_2023_12_NE),
               ("strip_prefix", "result", BARTS_PATH_2023_12_PREFIXES),
               ("unwrap", "result"),
               ("strip_prefix", "result", [" "])],
        date_format="yyyy-MM-dd HH:mm")


def barts_meas_2023_12() -> Recipe:
    return Recipe(
        key="2023_12_Barts_measurements", sep="\t", line_rules=[("strip_quotes",), ("width", BARTS_MEAS_TABS)],
        rename={"PseudoNHS_2023_11_08": "pseudo_nhs_number", "ClinicalSignificanceDate": "test_date",
                "EventType": "original_term", "EventResult": "result", "UnitsDesc": "result_value_units"},
        steps=[("strip_prefix", "result", [" "]),
               ("regex_block", "result", BARTS_MEAS_2023_12_FIRST_REGEX),
               ("ne", "result", BARTS_MEAS_2023_12_NE),
               ("regex_block", "result", BARTS_MEAS_2023_12_REGEX),
               ("ne", "result", BARTS_MEAS_2023_12_NE_2),
               ("regex_block", "result", BARTS_MEAS_2023_12_REGEX_2),
               ("ends_block", "result", BARTS_MEAS_2023_12_ENDS),
               ("regex_block", "result", BARTS_MEAS_2023_12_REGEX_3),
               ("ends_block", "result", BARTS_MEAS_2023_12_ENDS_2),
               ("regex_block", "result", BARTS_MEAS_2023_12_REGEX_4),
               ("strip_prefix", "result", [">"])],
        clock12=True)
