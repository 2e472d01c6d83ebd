"""Code value sets: what counts as a diagnosis, procedure, lab result, drug or template."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .expressions import ci, is_any, like_any
from .search import count_up_to


@dataclass(frozen=True)
class ValueSet:
    """Codes given by exact text, LIKE patterns and inclusive text ranges.

    Ranges compare text, so 'Z37.0' lies beyond the range ('Z30', 'Z37'). All comparison
    ignores case and trailing blanks. ``table`` names codes held in a DataFrame, for sets too
    long to write down: a ``code`` column and, where not all are exact codes, ``kind`` ('exact'
    or NULL, 'range' up to ``code_to``, or 'pattern').
    """

    exact: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()
    ranges: tuple[tuple[str, str], ...] = ()
    table: DataFrame | None = None

    def matches(self, col: Column | str) -> Column:
        """Predicate for the codes written down here (not those in ``table``)."""
        parts = []
        if self.exact:
            parts.append(is_any(col, dict.fromkeys(self.exact)))
        if self.patterns:
            parts.append(like_any(col, dict.fromkeys(self.patterns)))
        parts += [F.upper(ci(col)).between(lo, hi) for lo, hi in self.ranges]
        return reduce(lambda a, b: a | b, parts, F.lit(False))

    def filter(self, dim: DataFrame, col: str) -> DataFrame:
        """Rows of a dimension whose code is in the set."""
        if self.table is None:
            return dim.where(self.matches(col))
        return self.mark(dim, col, "_in_set").where("_in_set").drop("_in_set")

    def mark(self, df: DataFrame, col: str, name: str) -> DataFrame:
        """``df`` with a true/false column telling whether the code is in the set."""
        hit = F.coalesce(self.matches(col), F.lit(False))
        if self.table is None:
            return df.withColumn(name, hit)
        kinds = "kind" in self.table.columns
        exact = self.table.where("kind IS NULL OR kind = 'exact'") if kinds else self.table
        codes = exact.select(ci("code").alias("_code"), F.lit(True).alias("_listed")).distinct()
        marked = df.withColumn("_key", ci(col)).join(codes, F.col("_key") == F.col("_code"), "left")
        hit = hit | F.col("_listed").isNotNull()
        if not kinds:
            return marked.withColumn(name, hit).drop("_key", "_code", "_listed")
        index = code_index(self.table)
        marked = marked.withColumns({"_index": index.select(F.struct("starts", "ends", "wild")).scalar(), "_key": F.upper("_key")})
        place = count_up_to(F.col("_index.starts"), F.col("_key"))
        within = F.get(F.col("_index.ends"), place - 1) >= F.col("_key")
        wild = F.exists("_index.wild", lambda p: F.like(F.col("_key"), p))
        return marked.withColumn(name, hit | F.coalesce(within, F.lit(False)) | F.coalesce(wild, F.lit(False))).drop(
            "_key", "_code", "_listed", "_index")


#: Sorts after whatever follows a prefix.
_LAST = "\U0010FFFF"


def code_index(table: DataFrame) -> DataFrame:
    """One row: the ranges and prefixes of a stored code table as sorted intervals of text, and its other patterns.

    ``starts`` are the intervals' first texts in order, ``ends`` the furthest text that any interval up to there
    reaches; a code is listed if it is not beyond the end that belongs to the last start before it. A pattern whose
    only wildcard is a last '%' is a prefix, hence an interval; others stay patterns.
    """
    code = F.upper(ci("code"))
    prefix = (F.col("kind") == "pattern") & F.rtrim("code").rlike("^[^%_]*%$")
    cut = F.expr("substring(_code, 1, char_length(_code) - 1)")
    rules = table.select(code.alias("_code"), F.upper(ci("code_to")).alias("_to"), "kind", prefix.alias("_prefix"))
    spans = rules.select(
        F.when(F.col("kind") == "range", F.col("_code")).when(F.col("_prefix"), cut).alias("low"),
        F.when(F.col("kind") == "range", F.col("_to")).when(F.col("_prefix"), F.concat(cut, F.lit(_LAST))).alias("high"),
        F.when((F.col("kind") == "pattern") & ~F.col("_prefix"), F.col("_code")).alias("wild"))
    furthest = Window.orderBy("low").rowsBetween(Window.unboundedPreceding, 0)
    ordered = spans.withColumn("furthest", F.max("high").over(furthest))
    listed = F.sort_array(F.collect_list(F.when(F.col("low").isNotNull(), F.struct("low", "furthest"))))
    return ordered.agg(listed.alias("listed"), F.collect_set("wild").alias("wild")).select(
        F.col("listed.low").alias("starts"), F.col("listed.furthest").alias("ends"), "wild")


# ---------------------------------------------------------------------------------------
# The codes below decide the results and are kept as they are in use,
# duplicates and known typing slips ('VO2.8', '99214,') included.
# ---------------------------------------------------------------------------------------

SUPERVISED_PREGNANCY = (
    "Z34", "Z34.0", "Z34.00", "Z34.01", "Z34.02", "Z34.03", "Z34.8", "Z34.80", "Z34.81",
    "Z34.82", "Z34.83", "Z34.9", "Z34.90", "Z34.91", "Z34.92", "Z34.93",
)

PAP_ORDER_PATTERNS = (
    "%8011%", "%58315%", "%58316%", "%90933%", "%90934%", "%92087%", "%91339%", "%58355%",
    "%91392%", "%91393%", "%91395%", "%91394%", "%91906%", "%91911%", "%91912%", "%92012%",
    "%92082%", "%92087%", "%92088%", "%92090%", "%92092%", "%92094%", "%92102%", "%92238%",
    "%14499%", "%18817X%", "%18810X%", "%18828X%",
)

PAP_RESULT_PATTERNS = ("%90001256%", "%APResult%")

FIT_RESULTS = ("75400597", "75400599", "2008", "2096", "2097")

A1C_RESULTS = ("2040", "50026400")

DIABETES_OR_CKD_PATTERNS = ("E10%", "E11%", "E13%", "N18%")

DIABETES_PATTERNS = ("E10%", "E11%", "O24%", "E13%", "E09%", "E08%")

DEPRESSION_RANGE = (("F30", "F39"),)

SEXUALLY_ACTIVE_ICD10_PATTERNS = (
    "A34%", "A51%", "A52%", "A53%", "A54.%", "A55%", "A56%", "A57%", "A58%", "A59.%", "A60.%",
    "A63%", "A64%", "B20%", "B97.%", "F53%", "G44.%", "F52.%", "N70%", "N71%", "N93.%", "N94.%",
    "N96%", "N97%", "O09%", "O94%", "O98%", "O99%", "O9A%", "T38.4%", "T83.3%", "Z03.7%",
    "Z20.2%", "Z39%", "Z64.0%", "Z92.0%", "Z64.1%", "Z72.5%", "Z79.3%", "Z97.5%", "Z98.51%",
)

SEXUALLY_ACTIVE_ICD10_RANGES = (
    ("Z30", "Z37"), ("O00", "O16"), ("O20", "O29"), ("O30", "O48"), ("O60", "O77"),
    ("O80", "O82"), ("O85", "O92"),
)

SEXUALLY_ACTIVE_PROCEDURES = (
    "11975", "11976", "11977", "57022", "57170", "58300", "58301", "58600", "58605", "58611",
    "58615", "58970", "58974", "58976", "59000", "59001", "59012", "59015", "59020", "59025",
    "59030", "59050", "59051", "59070", "59072", "59074", "59076", "59100", "59120", "59121",
    "59130", "59135", "59136", "59140", "59150", "59151", "59160", "59200", "59300", "59320",
    "59325", "59350", "59400", "59409", "59410", "59412", "59414", "59425", "59426", "59430",
    "59510", "59514", "59515", "59525", "59610", "59612", "59614", "59618", "59620", "59622",
    "59812", "59820", "59821", "59830", "59840", "59841", "59850", "59851", "59852", "59855",
    "59856", "59857", "59866", "59870", "59871", "59897", "59898", "59899", "76801", "76805",
    "76811", "76813", "76815", "76816", "76817", "76818", "76819", "76820", "76821", "76825",
    "76826", "76827", "76828", "76941", "76945", "76946", "80055", "81025", "82105", "82106",
    "82143", "82731", "83632", "58300UA", "58300UA", "58301AG", "58301ZK", "83661", "83662",
    "83663", "83664", "84163", "84702", "84703", "84704", "86592", "86593", "86631", "86632",
    "87110", "87164", "87166", "87270", "87320", "87490", "87491", "87492", "87590", "87591",
    "87592", "87620", "87621", "87622", "87660", "87800", "87801", "87808", "87810", "87850",
    "88141", "88142", "88143", "88147", "88148", "88150", "88152", "88153", "88154", "88155",
    "88164", "88165", "88166", "88167", "88174", "88175", "88235", "88267", "88269",
)

SEXUALLY_ACTIVE_ICD9 = (
    "042", "054.10", "054.11", "054.12", "054.19", "078.11", "078.88", "079.4", "079.51",
    "079.52", "079.53", "079.88", "079.98", "091", "092", "093", "094", "095", "096", "097",
    "098.0", "098.10", "098.11", "098.15", "098.16", "098.17", "098.18", "098.19", "098.2",
    "098.30", "098.31", "098.35", "098.8", "099", "131", "614", "615", "616", "622.3", "623.4",
    "626.7", "628", "795.0", "795.1", "996.32", "V01.6", "V02.7", "VO2.8", "V08", "V15.7",
    "V22", "V23", "V24", "V26", "V27", "V28", "V45.5", "V61.5", "V61.6", "V61.7", "V69.2",
    "V72.3", "V72.4", "V73.81", "V73.88", "V73.98", "V74.5", "V76.2",
)

CONTRACEPTIVE_DRUGS = (
    "Nonoxynol-9", "VCF Vaginal Contraceptive%", "Vaginal Contraceptive%", "Apri", "Balziva%",
    "Cyclessa", "Desogen", "Enpresse", "Estrostep%", "Generes%", "Gildess%", "Activella",
    "Alesse-28", "Altavera", "AndroGel Packets", "Aviane", "BIRTH CONTROL%", "CAMILA%",
    "Conceptrol", "Condoms%", "CONTRACEPTIVE%", "Cryselle%", "Cyclafem%", "DEPO%",
    "drospirenone-ethinyl estradiol", "EMERGENCY PILL", "Errin%", "ethinyl estradiol%",
    "Femcon%", "Gianvi", "Heather", "IMPLANON", "Intrauterine Device (IUD)", "IUD%",
    "Jolivette", "Junel%", "Kariva%", "Levlen%", "levonorgestrel%", "Levora%",
    "Lo Loestrin Fe%", "Lo/Ovral%", "Loestrin%", "Loryna%", "Low-Ogestrel%", "Lutera%",
    "lybrel%", "medroxy%", "MERZALONE%", "Microgestin%", "micronor%",
    "MINI PILL (BIRTH CONTROL PILLS)%", "Mircette%", "Mirena%", "Modicon%", "Mononessa%",
    "Necon%", "Next choice%", "Nora-BE%", "Nordette%", "Noreth-Ethinyl Estradiol-Iron%",
    "norethindrone%", "NORGESTIMATE-ETH ESTRADIOL TAB%", "norgestimate-ethinyl estradiol%",
    "nor-plan%", "NuvaRing%", "Nor-QD%", "Nortrel%", "OC PILLS%", "OCP%", "Ocella%", "Ortho%",
    "Ovcon%", "ParaGard%", "Plan B%", "Portia%", "Premarin%", "Premphase%", "Prempro%",
    "PROGESTERON%", "Provera%", "PT TAKES%", "Quasense%", "Reclipsen%", "Seasonale%",
    "Seasonale%", "spermicide%", "Sprintec%", "Sronyx%", "testosterone%", "Tilia Fe%", "Tri%",
    "UNKNOWN BCP%", "USE AS DIRECTED%", "vaginal ring%", "Velivet%", "Yasmin%", "Yaz%",
    "Zarah%", "Zovia%",
)

CHLAMYDIA_RESULTS = (
    "ALERT CHLAMYDIA", "C trach rRNA XXX QI PCR", "C. TRAC/N. GONO SCREEN:",
    "C. TRACHOMATIS AB (IGA)", "C. TRACHOMATIS AB (IGG)", "C. TRACHOMATIS AB (IGM)",
    "C. TRACHOMATIS CULTURE", "C. TRACHOMATIS DNA PROBE RESULT:", "C. TRACHOMATIS IGA",
    "C. TRACHOMATIS IGG", "C. trachomatis IgG Titer", "C. TRACHOMATIS IGM",
    "C. trachomatis IgM Titer", "C. TRACHOMATIS RESULT:", "C. TRACHOMATIS RNA, TΜΑ",
    "C.TRACHOMATIS (DK) IGA", "C.TRACHOMATIS (DK) IGG", "C.TRACHOMATIS (DK) IGM",
    "C.TRACHOMATIS (L2) IGA", "C.TRACHOMATIS (L2) IGG", "C.TRACHOMATIS (L2) IGM",
    "C.TRACHOMATIS RNA, TMA", "C.TRACHOMATIS TMA, THROAT", "Chlamydia", "CHLAMYDIA AMPLIF",
    "CHLAMYDIA IGG ANTIBODY", "Chlamydia IgM Panel Interpretation",
    "CHLAMYDIA TRACHOMATIS DNA, SDA", "CHLAMYDIA TRACHOMATIS DNA, SDA, PAP VIAL",
    "CHLAMYDIA TRACHOMATIS RNA, TMA", "CHLAMYDIA TRACHOMATIS RNA, TMA, RECTAL",
    "CHLAMYDIA TRACHOMATIS RNA, TMA, THROAT", "CHLAMYDIA TRACHOMATIS RNA, TMA, UROGENITAL",
    "CHLAMYDIA TRACHOMATIS, TMA (ALT TARGET), UROGENITAL",
    "CHLAMYDIA TRACHOMATIS, TMA (ALTERNATE TARGET)", "Chlamydia/ Gonorrhoeae RNA",
    "Chlamydia/Gonorrhoeae RNA", "Chlamydia/Gonorrhoeae", "CT rRNA (TMA) - Rectal",
    "CT rRNA (TMA) - Throat", "CT rRNA (TMA) - Vaginal", "CT rRNA (TMA), PAP Vial",
    "CT rRNA (TMA), Probe", "CT rRNA (TMA), UR", "VAG CHLAMYDIA",
)

TERMINATION_PROCEDURES = (
    "1965", "1966", "59100", "59812", "59150", "59151", "59120", "59121", "59820", "59821",
    "59830", "59840", "59841", "59850", "59851", "59852", "59855", "59856", "59857", "59866",
    "59870", "88304",
)

TERMINATION_DIAGNOSES = (
    "O04.5", "O04.87", "O04.6", "O04.84", "O04.82", "O04.83", "O04.81", "O04.7", "O04.85",
    "O04.86", "O04.88", "O04.89", "O04.85", "O04.89", "O04.80", "Z33.2", "O07.0", "O07.1",
    "O07.37", "O07.34", "O07.32", "O07.33", "O07.31", "O07.2", "O07.35", "O07.36", "O07.38",
    "O07.39", "O07.30", "O07.4", "A34", "O08.0", "O08.1", "O08.6", "O08.4", "O08.5", "O08.3",
    "O08.2", "O08.7", "O08.82", "O08.81", "O08.83", "O08.89", "O08.9", "10A07ZZ", "10A08ZZ",
    "10D17ZZ", "10D18ZZ", "10A07ZZ", "10A08ZZ", "10A00ZZ", "10A03ZZ", "10A04ZZ",
)

CONTRACEPTION_PROCEDURES = (
    "FAMILY PLANNING", "Z9750", "S9445", "87081", "99401U6", "99402U6", "99403U6", "Z9752",
    "Z9753", "Z9754", "Z9751", "91030", "J7301", "A4269U3", "X1500", "J105", "J1055", "X6051",
    "J1050", "J1050UD", "J1055", "J3490", "J3490U8", "X6051", "J1050", "J3490U8", "A4261",
    "J7307UD", "57170", "57170ZK", "11975", "11981", "58300", "58300AG", "58300UA", "J7300",
    "METH", "X1522", "J7300UD", "X1522", "X1522UD", "X1514", "58301", "58301AG", "J7296",
    "A4267", "J7298", "J7298UD", "X7722", "58611", "58605", "91030",
)

CONTRACEPTION_DIAGNOSES = (
    "Z30.011", "Z30.013", "Z30.014", "Z30.015", "Z30.016", "Z30.017", "Z30.018", "Z30.019",
    "Z30.012", "Z30.02", "Z30.09", "Z30.430", "Z30.432", "Z30.433", "Z30.2", "Z30.40", "Z30.41",
    "Z30.431", "Z30.44", "Z30.45", "Z30.46", "Z30.49", "Z30.42", "Z30.8", "Z30.9", "Z31.0",
    "Z31.7", "Z31.89", "Z31.41", "Z31.42", "Z31.49", "Z31.430", "Z31.438", "Z31.440", "Z31.441",
    "Z31.448", "Z31.61", "Z31.62", "Z31.69", "Z31.9", "Z98.51", "Z98.52", "Z31.83", "Z31.84",
    "Z31.89", "Z31.90", "Z97.5",
)

REPRODUCTIVE_HEALTH_PROCEDURES = (
    "57510", "57511", "86631", "86632", "87110", "87270", "87320", "87490", "87491", "87810",
    "CHLAMYDIA", "G9228", "57452", "57454", "57455", "57456", "57460", "87800", "54050",
    "54055", "54056", "54057", "54060", "54065", "58100", "87081", "87590", "87591",
    "GONORRHEA", "87850", "86695", "86696", "87255", "86689", "86701", "86702", "86703",
    "87389", "HIV", "87536", "G0298", "G0432", "G0433", "G0435", "G0475", "S3645", "87624",
    "85014", "85018", "57460", "56501", "57061", "88112", "88141", "88142", "88150", "88164",
    "88175", "P3000", "P3001", "PAP", "Q0091", "57410", "86592", "86593", "86780", "SYPHILIS",
    "86780", "87210", "G8806", "G9113", "G9114", "G9115", "G9116", "G9117", "G9618", "Q0111",
    "S0610", "S0612", "S0613",
)

FAMILY_PLANNING_VISIT_PROCEDURES = (
    "99213", "99203", "11982", "99212", "99448", "G2012", "99395", "G0101", "81002", "99202",
    "58301", "99204", "99214,", "99401", "J3490", "J1050", "11976", "99402", "11981", "J7307",
    "58300", "J7298", "J7296", "99215", "11983", "J7300", "99000", "99447", "99442", "S9445",
    "11200", "J7301", "99446",
)

STERILISED_OR_MENOPAUSAL = (
    "Z90.710", "Z98.51", "Z98.52", "Z90.711", "Z90.712", "Z98.51", "Z30.2", "N95.0", "N95.1",
    "N95.2", "N95.8", "N95.9",
)

# Note templates that are no medical visit.
TEMPLATE_PATTERNS = (
    "%Nurse%", "%Labs%", "%inter%", "%care%", "%PM160%", "%Return%", "%Title%", "%CPSP%",
    "%Communication%", "%Referral%", "%PPD%", "%Hours%", "%HEADS%", "%Reminder%", "%Auth%",
    "%Quick%", "%Test%", "%IBH%", "%Message%", "%Service%", "%Delivery%", "%CCD%",
    "%Hospitalization Tracking%", "%COVID%", "%Good Faith Estimate%", "BH%",
)
TEMPLATE_NAMES = (
    "Questions For The Doctor", "SDoH Data Questions", "SDoH Case Management Engagement",
)
# What each of the three black-lists adds, and the template types it drops.
SIGN_OFF_PATTERNS = ("%podiatry%", "OB%", "%Amendment%")
SIGN_OFF_NAMES = ("Income / Self Declaration Form E/S",)
SIGN_OFF_TYPES = (69, 77, 79, 86, 66, 92, 84, 63, 70, 104, 94, 98, 65, 32)
MEDICAL_PATTERNS = ("%Amendment%",)
MEDICAL_TYPES = (69, 77, 76, 64, 79, 86, 66, 84, 63, 70, 104, 94, 98, 65, 32)
TOBACCO_PATTERNS = ("ob%", "gyn%", "%podiatry%")
TOBACCO_TYPES = (69, 77, 76, 64, 79, 86, 66, 92, 84, 63, 70, 104, 94, 98, 65, 32)

DENTAL_EXAMS = ("D0120", "D0145", "D0150")
DENTAL_RECALL = ("D0120",)
CARIES_RISK = ("D0601", "D0602", "D0603")
CARIES_MODERATE_HIGH = ("D0602", "D0603")
DENTAL_XRAYS = ("D0210", "D0220", "D0230", "D0270", "D0272", "D0274")
FLUORIDE = ("D1206",)
RESTORATIVE_PATTERNS = ("D21%", "D23%")
CROWN_IMPRESSION = ("C2002",)
CROWN_DELIVERY = ("D2752", "D2790", "D2791", "D2799")
SEALANT = ("D1351",)
SEALANT_CANDIDATE = ("C9017",)
PHASE_ONE_COMPLETED = ("C9011",)

# Clinic resource codes shown under a short name.
CLINIC_LABELS = {
    "No_Clinic": "", "EAGLEROCK": "ER", "SUNLAND": "SL", "CENTRAL": "CENT",
    "INACTIVE": "INACTIVE", "GLENDALE": "GL",
}
