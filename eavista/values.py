"""Fixed values.

Codes, names, labels, patterns and formats that must equal those of the
clinical deployment for the reports to be right. They are data, not logic, and
are kept together here. A concept code without a prefix belongs to the
deployment's own mapping source (``Dictionary.local_source``); a code written
``SOURCE:code`` belongs to that source.
"""

# --- encounter and identifier types (uuid) ---------------------------------
CONSULT = "aa61d509-6e76-4036-a65d-7813c0c3b752"
VITALS = "4fb47712-34a6-40d2-8ed3-e153abbd25b7"
REGISTRATION = "873f968a-73a8-4f9c-ac78-9f4778b751b6"
CLINICAL_HISTORY = "0d16a7c9-07fb-43f6-8984-dd7787f26a5a"
NATIONAL_ID = "c1fe3790-915a-4f03-861f-5e477f36cec0"
EMR_ID = "506add39-794f-11e8-9bcd-74e5f916c5ec"
DOSSIER_NUMBER = "9124b296-d14d-4222-862d-44867e728812"
DOSSIER_FORMAT = r"\w{1,4}\d{6}"

# --- settings --------------------------------------------------------------
DEFAULT_LOCALE = "es"
ICD10 = "ICD-10-WHO"
SHARED_SOURCE = "CIEL"

# --- vitals form: (column, concept code, kind) -----------------------------
VITALS_MEASURES = (
    ("height_cm", "HEIGHT (CM)", "numeric"),
    ("weight_kg", "WEIGHT (KG)", "numeric"),
    ("head_circumference", "HEAD CIRCUMFERENCE", "numeric"),
    ("systolic_bp", "SYSTOLIC BLOOD PRESSURE", "numeric"),
    ("diastolic_bp", "DIASTOLIC BLOOD PRESSURE", "numeric"),
    ("o2_sat", "BLOOD OXYGEN SATURATION", "numeric"),
    ("glucose_fasting", "Fasting for blood glucose test", "coded_list"),
    ("glucose_mg_dl", "SERUM GLUCOSE", "numeric"),
    ("temp_c", "TEMPERATURE (C)", "numeric"),
    ("heart_rate", "PULSE", "numeric"),
    ("resp_rate", "RESPIRATORY RATE", "numeric"),
    ("phq_2", "PHQ-2", "numeric"),
    ("gad_2", "GAD-2", "numeric"),
    ("chief_complaint", "CIEL:160531", "text"),
)

# --- clinical note: vitals part and consult part ---------------------------
NOTE_VITALS = (
    ("weight_kg", "WEIGHT (KG)", "numeric"),
    ("height_cm", "HEIGHT (CM)", "numeric"),
    ("systolic", "SYSTOLIC BLOOD PRESSURE", "numeric"),
    ("diastolic", "DIASTOLIC BLOOD PRESSURE", "numeric"),
    ("heart_rate", "PULSE", "numeric"),
    ("respiratory_rate", "RESPIRATORY RATE", "numeric"),
    ("temp_c", "TEMPERATURE (C)", "numeric"),
    ("vitals_glucose", "SERUM GLUCOSE", "numeric"),
    ("chief_complaint", "CIEL:160531", "text"),
)
NOTE_CONSULT = (
    ("waist_cm", "WAIST CIRCUMFERENCE CM", "numeric"),
    ("presenting_history", "PRESENTING HISTORY", "text"),
    ("analysis", "CLINICAL IMPRESSION COMMENTS", "text"),
    ("physical_exam", "PHYSICAL EXAMINATION", "text"),
    ("ultrasound_type", "14068", "coded_list"),
    ("ultrasound_notes", "7018", "text"),
    ("consult_glucose", "SERUM GLUCOSE", "numeric"),
    ("glucose_fasting", "Fasting for blood glucose test", "coded_list"),
    ("hba1c", "HbA1c", "numeric"),
    ("proteinuria", "URINARY ALBUMIN", "numeric"),
    ("cholesterol", "1006", "numeric"),
    ("hdl", "1007", "numeric"),
    ("ldl", "1008", "numeric"),
    ("plan", "10534", "text"),
)
GENDER_DISPLAY = {"M": "MASCULINO", "F": "FEMININO"}

# --- rapid tests: concept code -> label, and result wording -----------------
RAPID_TESTS = {
    "CIEL:163722": "Prueba de VIH",
    "CIEL:165303": "Prueba de sífilis",
    "HEPATITIS B TEST - QUALITATIVE": "Prueba de hepatitis B",
    "12335": "Prueba de clamidia",
    "12334": "Prueba de Gonorrea",
    "CIEL:21": "Prueba de hemoglobina",
    "BLOOD TYPING": "Tipo de sangre",
    "HEPATITIS C TEST - QUALITATIVE": "Prueba de hepatitis C",
    "Is TB suspected": "Sospecha de tuberculosis",
    "Is COVID suspected": "Sospecha de Covid-19",
}
BLOOD_TYPING = "BLOOD TYPING"
SUSPICIONS = ("Is TB suspected", "Is COVID suspected")
POSITIVE, NEGATIVE, YES_SHARED = "CIEL:703", "CIEL:664", "CIEL:1065"
POSITIVE_WORD, NEGATIVE_WORD = " positivo", " negativo"

# --- diagnoses --------------------------------------------------------------
DIAGNOSIS = "DIAGNOSIS"
DIAGNOSIS_TEXT = "Diagnosis or problem, non-coded"
DIAGNOSIS_TEXT_NUMBER = "7416"
DIAGNOSIS_ORDER = "Diagnosis order"
DIAGNOSIS_CERTAINTY = "CLINICAL IMPRESSION DIAGNOSIS CONFIRMED"
DIAGNOSIS_CERTAINTY_ARCHIVE = "Diagnosis Certainty"
CONFIRMED, PRIMARY, YES, OTHER = "CONFIRMED", "primary", "YES", "OTHER"
CONFIRMED_NAME = "Confirmado"

# --- registration -----------------------------------------------------------
INSURANCE = "Mexico Insurance Coded"
POPULAR_INSURANCE = "Seguro Popular"
POLICY_NUMBER = "Insurance policy number"
CIVIL_STATUS, OCCUPATION = "CIVIL STATUS", "Occupation"
FASTING_ANSWERS = ("YES", "NO")

# --- medication lines: (column, concept code, kind, part of the day) --------
MEDICATION_GROUP = "14822"
MEDICATION = "MEDICATION ORDERS"
DISPENSED_QUANTITY = "CIEL:1443"
CONTROLLED_SET = "20916"
PARTS_OF_DAY = {
    "morning": "IN THE MORNING",
    "noon": "3425",
    "afternoon": "In the afternoon",
    "evening": "IN THE EVENING",
}
MEDICATION_MEASURES = (
    ("name", MEDICATION, "drug", None),
    ("duration", "9075", "numeric", None),
    ("duration_units", "TIME UNITS", "coded_name", None),
    ("instructions", "9072", "text", None),
    ("dose_1", "9073", "numeric", None),
    ("dose_1_units", "Dosing units coded", "coded_short_name", None),
    ("dose_1_morning", "Part of the day", "comment", "morning"),
    ("dose_1_noon", "Part of the day", "comment", "noon"),
    ("dose_1_afternoon", "Part of the day", "comment", "afternoon"),
    ("dose_1_evening", "Part of the day", "comment", "evening"),
    ("dose_2", "14824", "numeric", None),
    ("dose_2_units", "14825", "coded_short_name", None),
    ("dose_2_morning", "14823", "comment", "morning"),
    ("dose_2_noon", "14823", "comment", "noon"),
    ("dose_2_afternoon", "14823", "comment", "afternoon"),
    ("dose_2_evening", "14823", "comment", "evening"),
)
DAY_LABELS = {
    "morning": ", Mañana: ",
    "noon": ", Medio dia: ",
    "afternoon": ", Tarde: ",
    "evening": ", Noche: ",
}

# --- clinical history -------------------------------------------------------
HISTORY_MEASURES = (
    ("family_history", "10144", "coded_list"),
    ("feeding", "14171", "text"),
    ("housing", "14172", "text"),
    ("home_occupation", "14174", "text"),
    ("hygiene", "14173", "text"),
    ("vaccine", "14175", "text"),
    ("other_non_path_history", "13749", "text"),
    ("daily_cigs", "12586", "numeric"),
    ("years_smoking", "12998", "numeric"),
    ("history_alcohol", "1552", "coded_list"),
    ("years_alcohol", "2241", "numeric"),
    ("number_transfusions", "13748", "numeric"),
    ("date_transfusion", "11064", "date"),
    ("type_transfusion", "7864", "coded_list"),
    ("number_surgeries", "13768", "numeric"),
    ("date_surgery", "13769", "date"),
    ("type_surgery", "13770", "text"),
    ("reason_surgery", "13771", "text"),
    ("number_hospitalizations", "12594", "numeric"),
    ("date_hospitalization", "12240", "date"),
    ("reason_hospitalization", "11065", "text"),
    ("other_pathological_history", "13752", "text"),
    ("age_first_menstrual_period", "13121", "numeric"),
    ("age_first_sexual_activity", "13250", "numeric"),
    ("blood_type", "300", "coded_list"),
    ("menstrual_cycle_details", "14176", "text"),
    ("gravida", "5624", "numeric"),
    ("parity", "1053", "numeric"),
    ("cesarian", "7011", "numeric"),
    ("abortions_before_20_weeks", "13733", "numeric"),
    ("abortions_after_20_weeks", "13734", "numeric"),
    ("date_previous_pregnancy", "13124", "date"),
    ("obstetric_notes", "6760", "text"),
    ("number_children", "11117", "numeric"),
    ("lmp_date", "968", "date"),
    ("has_had_menopause", "14188", "coded_list"),
    ("age_of_menopause", "14189", "numeric"),
    ("sti_notes", "1374", "text"),
    ("family_planning_notes", "5281", "text"),
    ("fp_method", "374", "coded_list"),
    ("pap_smear", "11319", "coded_list"),
    ("breast_exam", "14180", "coded_list"),
    ("main_symptom", "10137", "text"),
    ("evolution_symptoms", "10898", "coded_list"),
    ("digestive", "13757", "text"),
    ("respiratory", "13758", "text"),
    ("genital", "13760", "text"),
    ("urinary", "13759", "text"),
    ("cardiovascular", "13761", "text"),
    ("nervous_system", "13762", "text"),
    ("endocrine", "13764", "text"),
    ("locomotor", "13763", "text"),
    ("head", "10466", "text"),
    ("neck", "12900", "text"),
    ("chest", "10471", "text"),
    ("abdomen", "10469", "text"),
    ("extremities", "13754", "text"),
    ("otros_exam", "10468", "text"),
    ("diagnoses", "3064", "coded_list"),
)
HISTORY_VITALS = (
    ("temp", "5088", "numeric"),
    ("bp_systolic", "5085", "numeric"),
    ("bp_diastolic", "5086", "numeric"),
    ("weight", "5089", "numeric"),
    ("height", "5090", "numeric"),
    ("hr", "5087", "numeric"),
    ("rr", "5242", "numeric"),
)
PAP_SMEAR, BREAST_EXAM = "885", "20864"
PROCEDURE_DATE, PROCEDURE_COMMENT = "10485", "10483"

# labelled sentence parts: (label, column)
PATHOLOGICAL_LABELS = (
    ("Número de cigarros por día: ", "daily_cigs"),
    ("Tiempo fumando en años: ", "years_smoking"),
    ("Ingiere bebidas alcohólicas: ", "history_alcohol"),
    ("Tiempo tomando bebidas alcoholicas en años: ", "years_alcohol"),
    ("Número de transfusiones hasta el día de hoy: ", "number_transfusions"),
    ("Fecha de transfusión: ", "date_transfusion"),
    ("Tipo de transfusión: ", "type_transfusion"),
    ("Número de cirugías hasta el día de hoy: ", "number_surgeries"),
    ("Fecha de cirugía: ", "date_surgery"),
    ("Tipo de cirugía: ", "type_surgery"),
    ("Motivo: ", "reason_surgery"),
    ("Número de hospitalizaciones hasta el día de hoy: ", "number_hospitalizations"),
    ("Fecha de hospitalización: ", "date_hospitalization"),
    ("Motivo: ", "reason_hospitalization"),
    ("Otros antecedentes patológicos: ", "other_pathological_history"),
)
GYNECOLOGY_LABELS = (
    ("Edad de menarca: ", "age_first_menstrual_period"),
    ("Edad que inicio su vida sexual activa: ", "age_first_sexual_activity"),
    ("Tipo de sangre: ", "blood_type"),
    ("Ciclo menstrual: ", "menstrual_cycle_details"),
    ("Gravida (G): ", "gravida"),
    ("Parity (P): ", "parity"),
    ("Cesarian (C): ", "cesarian"),
    ("Perdidas menores de 20 SDG: ", "abortions_before_20_weeks"),
    ("Perdidas mayores de 20 SDG: ", "abortions_after_20_weeks"),
    ("Fecha de último evento obstétrico: ", "date_previous_pregnancy"),
    ("Notas : ", "obstetric_notes"),
    ("Número de hijos: ", "number_children"),
    ("FUM: ", "lmp_date"),
    ("Ha pasado por la menopausia: ", "has_had_menopause"),
    ("Edad que tuvo menopasia: ", "age_of_menopause"),
    ("Enfermedades de transmisión sexual: ", "sti_notes"),
    ("Método de planificación familiar usados: ", "family_planning_notes"),
    ("Método de planificación familiar usado actualmente: ", "fp_method"),
    ("Se ha hecho examen de papanicolaou: ", "pap_smear"),
    ("última fecha de la prueba de papanicolaou: ", "latest_pap_smear_date"),
    ("último resultado de la prueba de papanicolaou: ", "pap_smear_result"),
    ("comentarios sobre la prueba de Papanicolaou: ", "pap_smear_comments"),
    ("Se ha hecho exploración de mama: ", "breast_exam"),
    ("última fecha del examen de mama: ", "latest_breast_exam_date"),
    ("comentarios sobre el examen de mama: ", "breast_exam_comments"),
)
GENITOURINARY_LABELS = (("Aparato genital: ", "genital"), ("Aparato urinario: ", "urinary"))
HISTORY_COLUMNS = (
    "encounter_id", "encounter_date", "sheet_name", "full_facility_name", "location_name",
    "lastname", "firstname", "birthdate", "age", "gender", "address", "localidad", "telephone",
    "family_history", "non_pathological_history", "pathological_history", "gyn_history",
    "main_symptom", "evolution_symptoms", "digestive", "respiratory", "genitourinary",
    "cardiovascular", "nervous_system", "endocrine", "locomotor", "temp", "bp", "weight",
    "height", "hr", "rr", "otros_exam", "head", "neck", "chest", "abdomen", "extremities",
    "diagnoses", "entry_date", "provider", "latest_pap_smear_date", "pap_smear_result",
    "pap_smear_comments", "latest_breast_exam_date", "breast_exam_obs_group_id",
    "breast_exam_comments",
)

# --- facility names shown on the two documents ------------------------------
NOTE_FACILITIES = {
    "Honduras": "Casa de Salud Honduras",
    "Laguna del Cofre": "Unidad de Salud (US) Laguna del Cofre",
    "Capitan": "Unidad Médica Rural Capitán Luis A. Vidal",
    "Letrero": "Unidad de Salud (US) El Letrero",
    "Soledad": "Casa de Salud La Soledad",
    "Matazano": "Casa de salud El Matasanos",
    "Plan Alta": "Casa de Salud Plan de la Libertad",
    "Plan Baja": "Casa de Salud Plan de la Libertad",
    "Reforma": "Unidad de salud Reforma",
    "Salvador": "Urbina Casa de Salud Salvador Urbina",
    "Casa Materna": "Unidad de salud Jaltenango de la Paz",
    "CER": "Unidad de salud Jaltenango de la Paz",
    "CES Oficina": "Unidad de salud Jaltenango de la Paz",
    "Hospital": "Unidad de salud Jaltenango de la Paz",
    "Pediatría": "Unidad de salud Jaltenango de la Paz",
}
HISTORY_FACILITIES = {
    "Laguna del Cofre": "Unidad de Salud (US) Laguna del Cofre",
    "Letrero": "Unidad de Salud (US) El Letrero",
    "Salvador": "Casa de Salud Salvador Urbina",
    "Soledad": "Casa de Salud La Soledad",
    "Plan Alta": "Casa de Salud Plan de la Libertad",
    "Plan Baja": "Casa de Salud Plan de la Libertad",
    "Matazano": "Casa de salud El Matasanos",
    "Reforma": "Unidad de salud Reforma",
    "Capitan": "Unidad Médica Rural Capitán Luis A. Vidal",
    "Honduras": "Casa de Salud Honduras",
    "Monterrey": "Monterrey",
    "Plan de la Libertad": "Plan de la Libertad",
    "Jaltenango": "Unidad de salud Jaltenango de la Paz",
    "Surgery": "Unidad de salud Jaltenango de la Paz",
    "Hospital": "Unidad de salud Jaltenango de la Paz",
    "CES Oficina": "Unidad de salud Jaltenango de la Paz",
    "CER": "Unidad de salud Jaltenango de la Paz",
    "Casa Materna": "Unidad de salud Jaltenango de la Paz",
    "Patient Home": "Unidad de salud Jaltenango de la Paz",
    "Pediatría": "Unidad de salud Jaltenango de la Paz",
}
NOTE_DESIGNS = (
    ("IMSS-Bienestar", None),
    ("Juris X", "X MOTOZINTLA"),
    ("Juris IV", "IV VILLAFLORES"),
)

# --- sites and partitions ---------------------------------------------------
SITES = {
    "cesProd": 1, "capitan": 2, "honduras": 3, "laguna": 4, "letrero": 5, "matazano": 6,
    "monterrey": 7, "plan": 8, "planAlta": 9, "reforma": 10, "salvador": 11, "soledad": 12,
}
LAST_PARTITION_BOUNDARY = 50

# --- export formats ---------------------------------------------------------
CSV_ENCODING = "ISO-8859-1"
CSV_BLACKLIST = r"[^\p{InBasicLatin}\p{L}]"
CSV_DATE_FORMAT = "dd-MMM-yyyy HH:mm:ss"
LIST_SEPARATOR = " | "

# --- address hierarchy ------------------------------------------------------
ADDRESS_LEVELS = (
    "state_province", "county_district", "city_village", "address2", "address3", "address1",
)
REQUIRED_ADDRESS_LEVELS = ("state_province", "county_district")
ADDRESS_ENTRY_DELIMITER = "|"
ADDRESS_IDENTIFIER_DELIMITER = "^"

# --- questionnaires, similarity, migrations ---------------------------------
ANSWER_SCORES = {
    "Nunca": 0,
    "Pocos días": 1,
    "Más de la mitad de los días": 2,
    "Casi todos los días": 3,
}
SIMILARITY_WEIGHTS = {
    "county_district": 1,
    "city_village": 1,
    "address2": 1,
    "mother_name": 3,
    "phone": 20,
}
GESTATION_DAYS = 280
BMI_MIN_AGE = 5
HEAD_CIRCUMFERENCE_MAX_AGE = 6
RECODED_REASON = "migrate to new adjustment disorder diagnosis"
AMENDED = "AMENDED"
DUPLICATE_REASON = "clean up duplicates from initial load"
EXIT_PROGRAMS = ("asthma", "diabetes", "epilepsy", "maternal", "mental", "hypertension")
