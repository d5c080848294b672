"""Form tables as data: SURVEY Appendix B (columns) and Appendix C (output types).

Fixed values: every concept name, answer name, encounter-type name and output
column below must equal the source dictionary and warehouse DDL for results to
match; they are listed per table in the order the tables and columns are given.
``C(name, concept, value column, answer=..., agg=..., group=...)``: ``concept=None``
matches by answer only; ``group`` is the concept of the parent observation group.
``grouped`` columns are keyed by ``obs_group_id`` as well; ``untyped`` columns are
scanned without the encounter-type filter.

Decision: two heart-failure diagnosis dates (``diagnosis_date_restricitive``,
``diagnosis_date_valvular``) are scanned from the numeric value in the source
although the question and the target column are dates; they read the date value.
"""

from ..operators.pivot import PivotColumn as C

FORM_TABLES = {}

FORM_TABLES['mw_art_viral_load'] = dict(
    id_col='viral_load_visit_id',
    types=('Viral Load Screening',),
    columns=(
        C('ldl', 'Lower than Detection Limit', 'value_coded'),
        C('bled', 'Sample taken for Viral Load', 'value_coded'),
        C('lab_location', 'Location of laboratory', 'value_coded'),
        C('less_than_limit', 'Less than limit', 'value_numeric'),
        C('other_results', 'Reason for no result', 'value_coded'),
        C('reason_for_test', 'Reason for testing (coded)', 'value_coded'),
        C('sample_id', 'Viral Load Sample ID', 'value_text'),
        C('viral_load_result', 'HIV viral load', 'value_numeric'),
    ),
    grouped=frozenset(['bled', 'lab_location', 'ldl', 'less_than_limit', 'other_results', 'reason_for_test', 'sample_id', 'viral_load_result']),
    untyped=frozenset([]),
    ddl=("viral_load_visit_id long", "patient_id long", "visit_date date", "location string", "reason_for_test string", "lab_location string", "bled string", "sample_id string", "viral_load_result long", "less_than_limit long", "ldl string", "other_results string"),
)

FORM_TABLES['mw_mental_health_initial'] = dict(
    id_col='mental_health_initial_visit_id',
    types=('MENTAL_HEALTH_INITIAL',),
    columns=(
        C('diagnosis_date_mood_affective_disorder_depression', 'Diagnosis date', 'value_date'),
        C('alcohol_date_last_used', 'Date of exposure', 'value_date'),
        C('alcohol_exposure', 'History of alcohol use', 'value_coded'),
        C('alcohol_years_exposed', 'Duration in years', 'value_numeric'),
        C('behavior_problems_family_history', 'Family history of behavioral problems', 'value_coded'),
        C('delusions_date', 'Diagnosis date', 'value_date'),
        C('depressive_symptoms', 'Mental health chief complaint', 'value_coded', answer='Depressive Disorder'),
        C('depressive_symptoms_date', 'Diagnosis date', 'value_date'),
        C('diagnosis_schizophrenia', 'Chronic care diagnosis', 'value_coded', answer='Schizophrenia'),
        C('diagnosis_acute_and_transient_psychotic', 'Chronic care diagnosis', 'value_coded', answer='Acute Psychotic disorder'),
        C('diagnosis_anxiety_disorder', 'Chronic care diagnosis', 'value_coded', answer='Anxiety disorder'),
        C('diagnosis_date_schizophrenia', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_acute_and_transient_psychotic', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_anxiety_disorder', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_drug_use_mental_disorder', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_mood_affective_disorder_manic', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_organic_mental_disorder_acute', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_organic_mental_disorder_chronic', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_schizoaffective_disorder', 'Diagnosis date', 'value_date'),
        C('diagnosis_drug_use_mental_disorder', 'Chronic care diagnosis', 'value_coded', answer='Drug-induced mental and behavior disorder'),
        C('diagnosis_mood_affective_disorder_depression', 'Chronic care diagnosis', 'value_coded', answer='Depression'),
        C('diagnosis_mood_affective_disorder_manic', 'Chronic care diagnosis', 'value_coded', answer='Bipolar Affective Disorder, Manic'),
        C('diagnosis_organic_mental_disorder_acute', 'Chronic care diagnosis', 'value_coded', answer='Organic mental disorder (acute)'),
        C('diagnosis_organic_mental_disorder_chronic', 'Chronic care diagnosis', 'value_coded', answer='Organic mental disorder (chronic)'),
        C('diagnosis_schizoaffective_disorder', 'Chronic care diagnosis', 'value_coded', answer='Schizoaffective Disorder'),
        C('disorganised_or_disruptive_behaviour', 'Mental health chief complaint', 'value_coded', answer='Disruptive Behavior Disorder'),
        C('disorganised_speech', 'Mental health chief complaint', 'value_coded', answer='Abnormal speech'),
        C('epilepsy_family_history', 'Family history of epilepsy', 'value_coded'),
        C('hallucinations_date', 'Diagnosis date', 'value_date'),
        C('marijuana_date_last_used', 'Date of exposure', 'value_date', group='Marijuana use construct'),
        C('marijuana_exposure', 'History of exposure', 'value_coded', group='Marijuana use construct'),
        C('marijuana_years_exposed', 'Duration in years', 'value_numeric', group='Marijuana use construct'),
        C('mental_family_history', 'Family history of mental illness', 'value_coded'),
        C('other_complaints', 'Mental health chief complaint', 'value_coded', answer='Other non-coded'),
        C('other_complaints_date', 'Diagnosis date', 'value_date'),
        C('other_drugs_date_last_used', 'Date of exposure', 'value_date', group='Drug use construct'),
        C('other_drugs_exposure', 'History of exposure', 'value_coded', group='Drug use construct'),
        C('other_drugs_years_exposed', 'Duration in years', 'value_numeric', group='Drug use construct'),
        C('traditional_med_date_last_used', 'Date of exposure', 'value_date', group='Traditional medicine use construct'),
        C('traditional_med_exposure', 'History of exposure', 'value_coded', group='Traditional medicine use construct'),
        C('traditional_med_years_exposed', 'Duration in years', 'value_numeric', group='Traditional medicine use construct'),
        C('diagnosis_other_3', 'Chronic care diagnosis', 'value_coded'),
        C('art_start_date', 'Date antiretrovirals started', 'value_date'),
        C('delusions', 'Mental health chief complaint', 'value_coded', answer='Delusions'),
        C('diagnosis_alcohol_use_mental_disorder', 'Chronic care diagnosis', 'value_coded', answer='Alcohol-induced mental and behavior disorder'),
        C('diagnosis_date_alcohol_use_mental_disorder', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_other_1', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_other_2', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_other_3', 'Diagnosis date', 'value_date'),
        C('diagnosis_other_1', 'Other non-coded (text)', 'value_text'),
        C('diagnosis_other_2', 'Other non-coded (text)', 'value_text'),
        C('disorganised_or_disruptive_behaviour_date', 'Diagnosis date', 'value_date'),
        C('disorganised_speech_date', 'Diagnosis date', 'value_date'),
        C('hallucinations', 'Mental health chief complaint', 'value_coded', answer='Hallucinations'),
        C('hiv_status', 'HIV status', 'value_coded'),
        C('hiv_test_date', 'HIV test date', 'value_date'),
        C('tb_status', 'TB status', 'value_coded'),
        C('tb_year', 'Year of Tuberculosis diagnosis', 'value_numeric'),
    ),
    grouped=frozenset(['alcohol_date_last_used', 'alcohol_exposure', 'alcohol_years_exposed', 'delusions', 'delusions_date', 'depressive_symptoms', 'depressive_symptoms_date', 'diagnosis_acute_and_transient_psychotic', 'diagnosis_alcohol_use_mental_disorder', 'diagnosis_anxiety_disorder', 'diagnosis_date_acute_and_transient_psychotic', 'diagnosis_date_alcohol_use_mental_disorder', 'diagnosis_date_anxiety_disorder', 'diagnosis_date_drug_use_mental_disorder', 'diagnosis_date_mood_affective_disorder_depression', 'diagnosis_date_mood_affective_disorder_manic', 'diagnosis_date_organic_mental_disorder_acute', 'diagnosis_date_organic_mental_disorder_chronic', 'diagnosis_date_other_1', 'diagnosis_date_other_2', 'diagnosis_date_other_3', 'diagnosis_date_schizoaffective_disorder', 'diagnosis_date_schizophrenia', 'diagnosis_drug_use_mental_disorder', 'diagnosis_mood_affective_disorder_depression', 'diagnosis_mood_affective_disorder_manic', 'diagnosis_organic_mental_disorder_acute', 'diagnosis_organic_mental_disorder_chronic', 'diagnosis_other_1', 'diagnosis_other_2', 'diagnosis_other_3', 'diagnosis_schizoaffective_disorder', 'diagnosis_schizophrenia', 'disorganised_or_disruptive_behaviour', 'disorganised_or_disruptive_behaviour_date', 'disorganised_speech', 'disorganised_speech_date', 'hallucinations', 'hallucinations_date', 'marijuana_date_last_used', 'marijuana_exposure', 'marijuana_years_exposed', 'other_complaints', 'other_complaints_date', 'other_drugs_date_last_used', 'other_drugs_exposure', 'other_drugs_years_exposed', 'traditional_med_date_last_used', 'traditional_med_exposure', 'traditional_med_years_exposed']),
    untyped=frozenset([]),
    ddl=("mental_health_initial_visit_id long", "patient_id long", "visit_date date", "location string", "diagnosis_schizophrenia string", "diagnosis_date_schizophrenia date", "diagnosis_mood_affective_disorder_manic string", "diagnosis_date_mood_affective_disorder_manic date", "diagnosis_mood_affective_disorder_depression string", "diagnosis_date_mood_affective_disorder_depression date", "diagnosis_acute_and_transient_psychotic string", "diagnosis_date_acute_and_transient_psychotic date", "diagnosis_schizoaffective_disorder string", "diagnosis_date_schizoaffective_disorder date", "diagnosis_anxiety_disorder string", "diagnosis_date_anxiety_disorder date", "diagnosis_organic_mental_disorder_acute string", "diagnosis_date_organic_mental_disorder_acute date", "diagnosis_organic_mental_disorder_chronic string", "diagnosis_date_organic_mental_disorder_chronic date", "diagnosis_drug_use_mental_disorder string", "diagnosis_date_drug_use_mental_disorder date", "diagnosis_alcohol_use_mental_disorder string", "diagnosis_date_alcohol_use_mental_disorder date", "diagnosis_other_1 string", "diagnosis_date_other_1 date", "diagnosis_other_2 string", "diagnosis_date_other_2 date", "diagnosis_other_3 string", "diagnosis_date_other_3 date", "hiv_status string", "hiv_test_date date", "art_start_date date", "tb_status string", "tb_year double", "hallucinations string", "hallucinations_date date", "delusions string", "delusions_date date", "disorganised_or_disruptive_behaviour string", "disorganised_or_disruptive_behaviour_date date", "disorganised_speech string", "disorganised_speech_date date", "depressive_symptoms string", "depressive_symptoms_date date", "other_complaints string", "other_complaints_date date", "alcohol_exposure string", "alcohol_years_exposed double", "alcohol_date_last_used date", "marijuana_exposure string", "marijuana_years_exposed double", "marijuana_date_last_used date", "other_drugs_exposure string", "other_drugs_years_exposed double", "other_drugs_date_last_used date", "traditional_med_exposure string", "traditional_med_years_exposed double", "traditional_med_date_last_used date", "epilepsy_family_history string", "mental_family_history string", "behavior_problems_family_history string"),
)

FORM_TABLES['mw_art_followup'] = dict(
    id_col='art_followup_visit_id',
    types=('ART_FOLLOWUP',),
    columns=(
        C('art_regimen', 'Malawi Antiretroviral drugs received', 'value_coded'),
        C('arvs_given_to', 'Responsible person present', 'value_coded'),
        C('next_appointment_date', 'Appointment date', 'value_date'),
        C('condoms_given', 'Number of Condoms dispensed', 'value_numeric'),
        C('depo_given', 'Depo-Provera given', 'value_coded'),
        C('diastolic_bp', 'Diastolic blood pressure', 'value_numeric'),
        C('doses_missed', 'Number of HIV drug doses missed', 'value_numeric'),
        C('hiv_preventive_therapy', 'HIV Preventive Therapy', 'value_coded'),
        C('height', 'Height (cm)', 'value_numeric'),
        C('art_drugs_received', 'Malawi Antiretroviral drugs received', 'value_coded'),
        C('arvs_given', 'Number of antiretrovirals given', 'value_numeric'),
        C('pill_count', 'Amount of drug brought to clinic', 'value_numeric'),
        C('pregnant_or_lactating', 'Pregnant/Lactating', 'value_coded'),
        C('systolic_bp', 'Systolic blood pressure', 'value_numeric'),
        C('tb_status', 'TB status', 'value_coded'),
        C('therapy_pills', 'Amount dispensed', 'value_numeric'),
        C('weight', 'Weight (kg)', 'value_numeric'),
        C('no_side_effect', "Malawi ART side effects", "value_coded", answer='No'),
        C('peripheral_neuropathy_side_effect', "Malawi ART side effects", "value_coded", answer='Peripheral neuropathy'),
        C('hepatitis_side_effect', "Malawi ART side effects", "value_coded", answer='Hepatitis'),
        C('skin_rash_side_effect', "Malawi ART side effects", "value_coded", answer='Skin rash'),
        C('lipodystrophy_side_effect', "Malawi ART side effects", "value_coded", answer='Lipodystrophy'),
        C('other_side_effect', "Malawi ART side effects", "value_coded", answer='Other'),
    ),
    grouped=frozenset([]),
    untyped=frozenset(['art_drugs_received', 'art_regimen', 'arvs_given', 'arvs_given_to', 'condoms_given', 'depo_given', 'diastolic_bp', 'doses_missed', 'height', 'hepatitis_side_effect', 'hiv_preventive_therapy', 'lipodystrophy_side_effect', 'next_appointment_date', 'no_side_effect', 'other_side_effect', 'peripheral_neuropathy_side_effect', 'pill_count', 'pregnant_or_lactating', 'skin_rash_side_effect', 'systolic_bp', 'tb_status', 'therapy_pills', 'weight']),
    ddl=("art_followup_visit_id long", "patient_id long", "visit_date date", "location string", "next_appointment_date date", "art_drugs_received string", "pregnant_or_lactating string", "tb_status string", "doses_missed decimal(10,2)", "pill_count long", "no_side_effect string", "peripheral_neuropathy_side_effect string", "hepatitis_side_effect string", "skin_rash_side_effect string", "lipodystrophy_side_effect string", "other_side_effect string", "art_regimen string", "height decimal(10,2)", "weight decimal(10,2)", "arvs_given long", "arvs_given_to string", "hiv_preventive_therapy string", "therapy_pills decimal(10,2)", "depo_given string", "systolic_bp string", "diastolic_bp string", "condoms_given string"),
)

FORM_TABLES['mw_art_initial'] = dict(
    id_col='art_initial_visit_id',
    types=('ART_INITIAL',),
    columns=(
        C('art_second_line_regimen_start_date', 'Date of starting 2nd line ARV regimen', 'value_date'),
        C('art_alternative_first_line_regimen_date', 'Date of starting alternative 1st line ARV regimen', 'value_date'),
        C('art_alternative_first_line_regimen', 'Malawi Antiretroviral drugs change 2', 'value_coded'),
        C('art_first_line_regimen', 'Malawi Antiretroviral drugs change 1', 'value_coded'),
        C('art_first_line_regimen_start_date', 'Start date 1st line ARV', 'value_date'),
        C('art_second_line_regimen', 'Malawi Antiretroviral drugs change 3', 'value_coded'),
        C('art_education_date', 'ART education date', 'value_date'),
        C('art_education_done', 'ARV education done', 'value_coded'),
        C('age_at_initiation', 'Age', 'value_numeric'),
        C('cd4_count', 'CD4 count', 'value_numeric'),
        C('cd4_date', 'Date of CD4 count', 'value_date'),
        C('cd4_percentage', 'Cd4%', 'value_numeric'),
        C('child_hcc_no', 'Child HCC Registration Number', 'value_text'),
        C('clinical_stage', 'WHO stage', 'value_coded'),
        C('confirmatory_test_date', 'Date of HIV diagnosis', 'value_date'),
        C('confirmatory_test_location', 'Confirmatory HIV test location', 'value_text'),
        C('confirmatory_test_type', 'First positive HIV test type', 'value_coded'),
        C('ever_taken_arvs', 'Ever received ART?', 'value_coded'),
        C('height', 'Height (cm)', 'value_numeric'),
        C('ks_side_effects_worsening_on_arvs', 'Kaposis sarcoma side effects worsening while on ARVs?', 'value_coded'),
        C('last_arvs_taken', 'Last antiretroviral drugs taken', 'value_text'),
        C('last_arvs_taken_date', 'Date ART last taken', 'value_date'),
        C('pregnant_or_lactating', 'Pregnant/Lactating', 'value_coded'),
        C('presumed_hiv_severe_present', 'Presumed severe HIV criteria present', 'value_coded'),
        C('tb_registration_number', 'TB registration number', 'value_text'),
        C('tb_status', 'Tuberculosis treatment status', 'value_coded'),
        C('tb_treatment_start_date', 'Tuberculosis drug treatment start date', 'value_date'),
        C('transfer_in_date', 'Transfer in date', 'value_date'),
        C('who_clinical_conditions', 'Clinical Conditions Text', 'value_text'),
        C('weight', 'Weight (kg)', 'value_numeric'),
    ),
    grouped=frozenset([]),
    untyped=frozenset(['age_at_initiation', 'art_alternative_first_line_regimen', 'art_alternative_first_line_regimen_date', 'art_education_date', 'art_education_done', 'art_first_line_regimen', 'art_first_line_regimen_start_date', 'art_second_line_regimen', 'art_second_line_regimen_start_date', 'cd4_count', 'cd4_date', 'cd4_percentage', 'child_hcc_no', 'clinical_stage', 'confirmatory_test_date', 'confirmatory_test_location', 'confirmatory_test_type', 'ever_taken_arvs', 'height', 'ks_side_effects_worsening_on_arvs', 'last_arvs_taken', 'last_arvs_taken_date', 'pregnant_or_lactating', 'presumed_hiv_severe_present', 'tb_registration_number', 'tb_status', 'tb_treatment_start_date', 'transfer_in_date', 'weight', 'who_clinical_conditions']),
    ddl=("art_initial_visit_id long", "patient_id long", "visit_date date", "location string", "who_clinical_conditions string", "clinical_stage string", "presumed_hiv_severe_present string", "tb_status string", "cd4_count long", "cd4_percentage decimal(6,2)", "ks_side_effects_worsening_on_arvs string", "cd4_date date", "pregnant_or_lactating string", "height decimal(10,2)", "weight decimal(10,2)", "ever_taken_arvs string", "age_at_initiation long", "last_arvs_taken string", "last_arvs_taken_date string", "confirmatory_test_location string", "confirmatory_test_date date", "confirmatory_test_type string", "art_education_done string", "art_education_date date", "tb_registration_number string", "tb_treatment_start_date date", "art_first_line_regimen string", "art_first_line_regimen_start_date date", "art_alternative_first_line_regimen string", "art_alternative_first_line_regimen_date date", "art_second_line_regimen string", "art_second_line_regimen_start_date date", "transfer_in_date date", "child_hcc_no string"),
)

FORM_TABLES['mw_art_visits'] = dict(
    id_col='art_visit_id',
    types=('ART_INITIAL', 'ART_FOLLOWUP'),
    columns=(
        C('next_appointment_date', 'Appointment date', 'value_date'),
        C('art_drug_regimen', 'Malawi Antiretroviral drugs received', 'value_coded'),
    ),
    grouped=frozenset([]),
    untyped=frozenset(['art_drug_regimen', 'next_appointment_date']),
    ddl=("art_visit_id long", "patient_id long", "visit_date date", "location string", "art_drug_regimen string", "next_appointment_date date"),
)

FORM_TABLES['mw_asthma_followup'] = dict(
    id_col='asthma_followup_visit_id',
    types=('ASTHMA_FOLLOWUP',),
    columns=(
        C('asthma_severity', 'Asthma classification', 'value_coded'),
        C('cooking_indoor', 'Location of cooking', 'value_coded'),
        C('copd', 'Chronic care diagnosis', 'value_coded', answer='Chronic obstructive pulmonary disease'),
        C('day_symptoms', 'Daytime symptom frequency', 'value_numeric'),
        C('exacerbation_today', 'Asthma exacerbation today', 'value_coded'),
        C('height', 'Height (cm)', 'value_numeric'),
        C('inhaler_use_frequency_daily', 'Inhaler use per day', 'value_numeric'),
        C('inhaler_use_frequency_monthly', 'Inhaler use per month', 'value_numeric'),
        C('inhaler_use_frequency_weekly', 'Inhaler use per week', 'value_numeric'),
        C('inhaler_use_frequency_yearly', 'Number of times inhaler is used in a year', 'value_numeric'),
        C('night_symptoms', 'Nighttime symptom frequency', 'value_numeric'),
        C('number_of_cigarettes_per_day', 'Number of cigarettes smoked per day', 'value_numeric'),
        C('other_diagnosis', 'Other diagnosis', 'value_text'),
        C('passive_smoking', 'Exposed to second hand smoke?', 'value_coded'),
        C('planned_visit', 'Scheduled visit', 'value_coded'),
        C('steroid_inhaler_daily', 'Daily inhaled steroid use', 'value_coded'),
        C('treatment_inhaled_b_agonist', 'Chronic lung disease treatment', 'value_coded', answer='Beta-agonists (inhaled)'),
        C('weight', 'Weight (kg)', 'value_numeric'),
        C('comments', 'Clinical impression comments', 'value_text'),
        C('treatment_inhaled_steriod', 'Chronic lung disease treatment', 'value_coded', answer='Inhaled steroid'),
        C('treatment_oral_steroid', 'Chronic lung disease treatment', 'value_coded', answer='Oral steroid'),
        C('other_treatment', 'Chronic lung disease treatment', 'value_coded', answer='Other non-coded'),
    ),
    grouped=frozenset([]),
    untyped=frozenset([]),
    ddl=("asthma_followup_visit_id long", "patient_id long", "visit_date date", "location string", "planned_visit string", "height long", "weight long", "day_symptoms long", "night_symptoms long", "inhaler_use_frequency_daily long", "inhaler_use_frequency_weekly long", "inhaler_use_frequency_monthly long", "inhaler_use_frequency_yearly long", "steroid_inhaler_daily string", "number_of_cigarettes_per_day long", "passive_smoking string", "cooking_indoor string", "exacerbation_today string", "asthma_severity string", "copd string", "other_diagnosis string", "treatment_inhaled_b_agonist string", "treatment_inhaled_steriod string", "treatment_oral_steroid string", "other_treatment string", "comments string"),
)

FORM_TABLES['mw_asthma_initial'] = dict(
    id_col='asthma_initial_visit_id',
    types=('ASTHMA_INITIAL',),
    columns=(
        C('art_start_date', 'Date antiretrovirals started', 'value_date'),
        C('chronic_dry_cough', 'Symptom present', 'value_coded', answer='Dry cough'),
        C('chronic_dry_cough_age_at_onset', 'Age at cough onset', 'value_numeric'),
        C('chronic_dry_cough_duration_in_months', 'Duration of symptom in months', 'value_numeric'),
        C('cooking_indoor', 'Location of cooking', 'value_coded', answer='Indoors'),
        C('diagnosis_asthma', 'Chronic care diagnosis', 'value_coded', answer='Asthma'),
        C('diagnosis_copd', 'Chronic care diagnosis', 'value_coded', answer='Chronic obstructive pulmonary disease'),
        C('diagnosis_date_asthma', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_copd', 'Diagnosis date', 'value_date'),
        C('family_history_asthma', 'Asthma family history', 'value_coded'),
        C('family_history_copd', 'COPD family history', 'value_coded'),
        C('hiv_status', 'HIV status', 'value_coded'),
        C('hiv_test_date', 'HIV test date', 'value_date'),
        C('tb_contact', 'Exposure', 'value_coded', answer='Contact with a TB+ person'),
        C('tb_contact_date', 'Date of exposure', 'value_date'),
        C('tb_status', 'TB status', 'value_coded'),
        C('tb_year', 'Year of Tuberculosis diagnosis', 'value_numeric'),
        C('cooking_indoor', 'Location of cooking', 'value_coded', answer='Outdoors'),
        C('last_smoking_history_date', 'Last time person used tobacco', 'value_date'),
        C('occupation', 'Main activity', 'value_coded'),
        C('occupation_exposure', 'Exposure', 'value_coded', answer='Occupational exposure'),
        C('occupation_exposure_date', 'Date of exposure', 'value_date'),
        C('second_hand_smoking', 'Exposure', 'value_coded', answer='Exposed to second hand smoke?'),
        C('second_hand_smoking_date', 'Date of exposure', 'value_date'),
        C('smoking_history', 'Smoking history', 'value_coded', answer='In the past'),
    ),
    grouped=frozenset(['diagnosis_asthma', 'diagnosis_copd', 'diagnosis_date_asthma', 'diagnosis_date_copd', 'occupation_exposure', 'occupation_exposure_date', 'second_hand_smoking', 'second_hand_smoking_date', 'tb_contact', 'tb_contact_date']),
    untyped=frozenset([]),
    ddl=("asthma_initial_visit_id long", "patient_id long", "visit_date date", "location string", "diagnosis_asthma string", "diagnosis_date_asthma date", "diagnosis_copd string", "diagnosis_date_copd date", "family_history_asthma string", "family_history_copd string", "hiv_status string", "hiv_test_date date", "art_start_date date", "tb_status string", "tb_year long", "chronic_dry_cough string", "chronic_dry_cough_duration_in_months long", "chronic_dry_cough_age_at_onset long", "tb_contact string", "tb_contact_date date", "cooking_indoor string", "smoking_history string", "last_smoking_history_date date", "second_hand_smoking string", "second_hand_smoking_date date", "occupation string", "occupation_exposure string", "occupation_exposure_date date"),
)

FORM_TABLES['mw_chf_followup'] = dict(
    id_col='chf_followup_visit_id',
    types=('CHF_FOLLOWUP',),
    columns=(
        C('ace_i_capt', 'Current drugs used', 'value_coded', answer='Captopril'),
        C('ace_i_enal', 'Current drugs used', 'value_coded', answer='Enalapril'),
        C('ace_i_lisin', 'Current drugs used', 'value_coded', answer='Lisinopril'),
        C('alcohol', 'History of alcohol use', 'value_coded'),
        C('aspirin', 'Current drugs used', 'value_coded', answer='Aspirin'),
        C('bb_aten', 'Current drugs used', 'value_coded', answer='Atenolol'),
        C('bb_bis', 'Current drugs used', 'value_coded', answer='Bisoprolol'),
        C('bb_prop', 'Current drugs used', 'value_coded', answer='Propranolol'),
        C('benzathine', 'Current drugs used', 'value_coded', answer='Benzathine penicillin'),
        C('bibasilar_crackles', 'Bibasilar crackles', 'value_coded'),
        C('bp_diastolic', 'Diastolic blood pressure', 'value_numeric'),
        C('bp_systolic', 'Systolic blood pressure', 'value_numeric'),
        C('ccb_aml', 'Current drugs used', 'value_coded', answer='Amlodipine'),
        C('ccb_nif', 'Current drugs used', 'value_coded', answer='Nifedipine'),
        C('concern_for_depression_or_anxiety', 'Concern for depression or anxiety', 'value_coded'),
        C('diet_salt_or_fluid', 'Low salt diet recommended', 'value_coded'),
        C('diuretic_furo', 'Current drugs used', 'value_coded', answer='Furosemide'),
        C('diuretic_hctz', 'Current drugs used', 'value_coded', answer='Hydrochlorothiazide'),
        C('diuretic_spiro', 'Current drugs used', 'value_coded', answer='Spironolactone'),
        C('dry_cough', 'Level of dry cough', 'value_coded'),
        C('dyspnea_on_exertion', 'Dyspnea on extertion', 'value_coded'),
        C('fatigue', 'Level of fatigue', 'value_coded'),
        C('heart_rate', 'Pulse', 'value_numeric'),
        C('height', 'Height (cm)', 'value_numeric'),
        C('hospitalized_since_last_visit_for_ncd', 'Hospitalized for non-communicable disease since last visit', 'value_coded'),
        C('jvp_elevated', 'Jugular venous pressure elevated', 'value_coded'),
        C('mental_health_referral', 'Mental health referral', 'value_coded'),
        C('next_appointment_date', 'Appointment date', 'value_date'),
        C('nyha_stage', 'Nyha class', 'value_coded'),
        C('oedema', 'Oedema', 'value_coded'),
        C('orthopnea', 'Level of orthopnea', 'value_coded'),
        C('other_medications', 'Other chronic heart failure drugs', 'value_text'),
        C('palliative_referral', 'Palliative care referral', 'value_coded'),
        C('request_chw_f_u', 'Follow up agreement', 'value_coded'),
        C('spo2', 'Blood oxygen saturation', 'value_numeric'),
        C('tobacco', 'Smoking history', 'value_coded'),
        C('took_medications_today', 'Took medications today', 'value_coded'),
        C('volume_status', 'Patients fluid management', 'value_coded'),
        C('weight', 'Weight (kg)', 'value_numeric'),
        C('weight_change', 'Weight change', 'value_text'),
        C('salt_or_fluid_restricted', 'Salt or fluid restricted', 'value_coded'),
    ),
    grouped=frozenset([]),
    untyped=frozenset([]),
    ddl=("chf_followup_visit_id long", "patient_id long", "visit_date date", "location string", "height long", "weight long", "weight_change string", "bp_systolic long", "bp_diastolic long", "heart_rate long", "spo2 long", "orthopnea string", "dyspnea_on_exertion string", "dry_cough string", "fatigue string", "hospitalized_since_last_visit_for_ncd string", "oedema string", "bibasilar_crackles string", "jvp_elevated string", "volume_status string", "nyha_stage string", "alcohol string", "tobacco string", "salt_or_fluid_restricted string", "concern_for_depression_or_anxiety string", "aspirin string", "diuretic_hctz string", "diuretic_furo string", "diuretic_spiro string", "ace_i_enal string", "ace_i_capt string", "ace_i_lisin string", "bb_aten string", "bb_bis string", "bb_prop string", "ccb_aml string", "ccb_nif string", "benzathine string", "other_medications string", "took_medications_today string", "diet_salt_or_fluid string", "mental_health_referral string", "palliative_referral string", "request_chw_f_u string", "next_appointment_date date"),
)

FORM_TABLES['mw_chf_initial'] = dict(
    id_col='chf_initial_visit_id',
    types=('CHF_INITIAL',),
    columns=(
        C('art_start_date', 'Date antiretrovirals started', 'value_date'),
        C('comorbidities_chronic_kidney_disease', 'Current opportunistic infection or comorbidity, confirmed or presumed', 'value_coded', answer='Chronic kidney disease'),
        C('comorbidities_diabetes', 'Current opportunistic infection or comorbidity, confirmed or presumed', 'value_coded', answer='Diabetes'),
        C('comorbidities_hypertension', 'Current opportunistic infection or comorbidity, confirmed or presumed', 'value_coded', answer='Hypertension'),
        C('comorbidities_other', 'Other diagnosis', 'value_text'),
        C('diagnosis_afib', 'Chronic care diagnosis', 'value_coded', answer='Irregular rhythm'),
        C('diagnosis_cad', 'Chronic care diagnosis', 'value_coded', answer='Coronary artery disease'),
        C('diagnosis_congenital', 'Chronic care diagnosis', 'value_coded', answer='Congenital heart disease'),
        C('diagnosis_date_rheumatic', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_afib', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_cad', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_congenital', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_dilated', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_dvt', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_other', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_pe', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_restricitive', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_stroke', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_unknown', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_valvular', 'Diagnosis date', 'value_date'),
        C('diagnosis_dilated', 'Chronic care diagnosis', 'value_coded', answer='Dilated cardiomyopathy'),
        C('diagnosis_dvt', 'Chronic care diagnosis', 'value_coded', answer='Deep vein thrombosis'),
        C('diagnosis_other', 'Chronic care diagnosis', 'value_coded'),
        C('diagnosis_pe', 'Chronic care diagnosis', 'value_coded', answer='Pulmonary embolism'),
        C('diagnosis_restricitive', 'Chronic care diagnosis', 'value_coded', answer='Restrictive cardiomyopathy'),
        C('diagnosis_rheumatic', 'Chronic care diagnosis', 'value_coded', answer='Rheumatic heart disease'),
        C('diagnosis_stroke', 'Chronic care diagnosis', 'value_coded', answer='Acute cerebrovascular attack'),
        C('diagnosis_unknown', 'Chronic care diagnosis', 'value_coded', answer='Unknown'),
        C('diagnosis_valvular', 'Chronic care diagnosis', 'value_coded', answer='Valvular heart disease'),
        C('ecg_test_date', 'Date of general test', 'value_date'),
        C('ecg_test_result', 'Electrocardiogram diagnosis', 'value_coded'),
        C('echo_test_date', 'Date of general test', 'value_date'),
        C('echo_test_result', 'ECHO imaging result', 'value_text'),
        C('hiv_status', 'HIV status', 'value_coded'),
        C('hiv_test_date', 'HIV test date', 'value_date'),
        C('tb_status', 'TB status', 'value_coded'),
        C('tb_year', 'Year of Tuberculosis diagnosis', 'value_numeric'),
    ),
    grouped=frozenset(['diagnosis_afib', 'diagnosis_cad', 'diagnosis_congenital', 'diagnosis_date_afib', 'diagnosis_date_cad', 'diagnosis_date_congenital', 'diagnosis_date_dilated', 'diagnosis_date_dvt', 'diagnosis_date_other', 'diagnosis_date_pe', 'diagnosis_date_restricitive', 'diagnosis_date_rheumatic', 'diagnosis_date_stroke', 'diagnosis_date_unknown', 'diagnosis_date_valvular', 'diagnosis_dilated', 'diagnosis_dvt', 'diagnosis_other', 'diagnosis_pe', 'diagnosis_restricitive', 'diagnosis_rheumatic', 'diagnosis_stroke', 'diagnosis_unknown', 'diagnosis_valvular', 'ecg_test_date', 'ecg_test_result', 'echo_test_date', 'echo_test_result']),
    untyped=frozenset([]),
    ddl=("chf_initial_visit_id long", "patient_id long", "visit_date date", "location string", "diagnosis_dilated string", "diagnosis_date_dilated date", "diagnosis_restricitive string", "diagnosis_date_restricitive date", "diagnosis_valvular string", "diagnosis_date_valvular date", "diagnosis_unknown string", "diagnosis_date_unknown date", "diagnosis_rheumatic string", "diagnosis_date_rheumatic date", "diagnosis_congenital string", "diagnosis_date_congenital date", "diagnosis_cad string", "diagnosis_date_cad date", "diagnosis_stroke string", "diagnosis_date_stroke date", "diagnosis_afib string", "diagnosis_date_afib date", "diagnosis_pe string", "diagnosis_date_pe date", "diagnosis_dvt string", "diagnosis_date_dvt date", "diagnosis_other string", "diagnosis_date_other date", "hiv_status string", "hiv_test_date date", "art_start_date date", "tb_status string", "tb_year long", "comorbidities_hypertension string", "comorbidities_diabetes string", "comorbidities_chronic_kidney_disease string", "comorbidities_other string", "echo_test_result string", "echo_test_date date", "ecg_test_result string", "ecg_test_date date"),
)

FORM_TABLES['mw_ckd_followup'] = dict(
    id_col='ckd_followup_visit_id',
    types=('CKD_FOLLOWUP',),
    columns=(
        C('ace_i_capt', 'Current drugs used', 'value_coded', answer='Captopril'),
        C('ace_i_enal', 'Current drugs used', 'value_coded', answer='Enalapril'),
        C('ace_i_lisin', 'Current drugs used', 'value_coded', answer='Lisinopril'),
        C('alcohol', 'History of alcohol use', 'value_coded'),
        C('anorexia', 'Patient has anorexia', 'value_coded'),
        C('ascites', 'Patient has ascites', 'value_coded'),
        C('bb_aten', 'Current drugs used', 'value_coded', answer='Atenolol'),
        C('bb_bis', 'Current drugs used', 'value_coded', answer='Bisoprolol'),
        C('bb_prop', 'Current drugs used', 'value_coded', answer='Propranolol'),
        C('bp_diastolic', 'Diastolic blood pressure', 'value_numeric'),
        C('bp_systolic', 'Systolic blood pressure', 'value_numeric'),
        C('ccb_aml', 'Current drugs used', 'value_coded', answer='Amlodipine'),
        C('ccb_nif', 'Current drugs used', 'value_coded', answer='Nifedipine'),
        C('ckd_stage', 'CKD stage', 'value_coded'),
        C('confusion', 'Patient confused (newly disoriented in place, person or time)', 'value_coded'),
        C('conjunctiva', 'Conjunctiva', 'value_coded'),
        C('creatinine', 'Creatinine', 'value_numeric'),
        C('diet_recommendations', 'Diet recommendations', 'value_coded'),
        C('diuretic_furo', 'Current drugs used', 'value_coded', answer='Furosemide'),
        C('diuretic_hctz', 'Current drugs used', 'value_coded', answer='Hydrochlorothiazide'),
        C('diuretic_spiro', 'Current drugs used', 'value_coded', answer='Spironolactone'),
        C('fatigue', 'Patient has fatigue', 'value_coded'),
        C('gfr', 'Glomerular filtration rate', 'value_numeric'),
        C('heart_rate', 'Pulse', 'value_numeric'),
        C('height', 'Height (cm)', 'value_numeric'),
        C('nausea', 'Patient has nausea', 'value_coded'),
        C('next_appointment_date', 'Appointment date', 'value_date'),
        C('nsaid_use', 'Nonsteroidal anti-inflammatory drug use', 'value_coded'),
        C('oedema', 'Oedema', 'value_coded'),
        C('other_medications', 'Other chronic heart failure drugs', 'value_text'),
        C('other_symptoms', 'Review of symptoms other', 'value_text'),
        C('pruritus', 'Patient has pruritus', 'value_coded'),
        C('tobacco', 'Smoking history', 'value_coded'),
        C('took_medications_today', 'Took medications today', 'value_coded'),
        C('urine_protein', 'Urine protein', 'value_coded'),
        C('weight', 'Weight (kg)', 'value_numeric'),
    ),
    grouped=frozenset([]),
    untyped=frozenset([]),
    ddl=("ckd_followup_visit_id long", "patient_id long", "visit_date date", "location string", "height long", "weight long", "bp_systolic long", "bp_diastolic long", "heart_rate long", "creatinine long", "gfr long", "urine_protein string", "confusion string", "fatigue string", "nausea string", "anorexia string", "pruritus string", "conjunctiva string", "ascites string", "oedema string", "other_symptoms string", "ckd_stage string", "nsaid_use string", "alcohol string", "tobacco string", "diuretic_hctz string", "diuretic_furo string", "diuretic_spiro string", "ace_i_enal string", "ace_i_capt string", "ace_i_lisin string", "bb_aten string", "bb_bis string", "bb_prop string", "ccb_aml string", "ccb_nif string", "other_medications string", "took_medications_today string", "diet_recommendations string", "next_appointment_date date"),
)

FORM_TABLES['mw_ckd_initial'] = dict(
    id_col='ckd_initial_visit_id',
    types=('CKD_INITIAL',),
    columns=(
        C('art_start_date', 'Date antiretrovirals started', 'value_date'),
        C('date_of_dialysis', 'Date of dialysis', 'value_date'),
        C('diagnosis_diabetes', 'Chronic care diagnosis', 'value_coded', answer='Diabetes'),
        C('diagnosis_hypertension', 'Chronic care diagnosis', 'value_coded', answer='Hypertension'),
        C('diagnosis_other', 'Chronic care diagnosis', 'value_coded', answer='Other non-coded'),
        C('diagnosis_chf', 'Chronic care diagnosis', 'value_coded', answer='Heart failure'),
        C('diagnosis_date_chf', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_diabetes', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_hypertension', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_other', 'Diagnosis date', 'value_date'),
        C('history_of_dialysis', 'History of dialysis', 'value_text'),
        C('hiv_status', 'HIV status', 'value_coded'),
        C('hiv_test_date', 'HIV test date', 'value_date'),
        C('presumed_etiology_diabetes', 'Presumed chronic kidney disease etiology', 'value_coded', answer='Diabetes'),
        C('presumed_etiology_diagnosis_date', 'Diagnosis date', 'value_date'),
        C('presumed_etiology_drugs', 'Presumed chronic kidney disease etiology', 'value_coded'),
        C('presumed_etiology_hiv', 'Presumed chronic kidney disease etiology', 'value_coded', answer='Human immunodeficiency virus'),
        C('presumed_etiology_hypertension', 'Presumed chronic kidney disease etiology', 'value_coded', answer='Hypertension'),
        C('presumed_etiology_nephrotic', 'Presumed chronic kidney disease etiology', 'value_coded', answer='Nephropathy'),
        C('presumed_etiology_other', 'drugs', 'value_text'),
        C('presumed_etiology_other_2', 'Presumed chronic kidney disease etiology', 'value_coded', answer='Other'),
        C('presumed_etiology_unknown', 'Presumed chronic kidney disease etiology', 'value_coded', answer='Unknown cause'),
        C('tb_date', 'Tuberculosis diagnosis date', 'value_date'),
        C('tb_status', 'TB status', 'value_coded'),
    ),
    grouped=frozenset(['diagnosis_chf', 'diagnosis_date_chf', 'diagnosis_date_diabetes', 'diagnosis_date_hypertension', 'diagnosis_date_other', 'diagnosis_diabetes', 'diagnosis_hypertension', 'diagnosis_other']),
    untyped=frozenset([]),
    ddl=("ckd_initial_visit_id long", "patient_id long", "visit_date date", "location string", "presumed_etiology_hypertension string", "presumed_etiology_diabetes string", "presumed_etiology_hiv string", "presumed_etiology_nephrotic string", "presumed_etiology_drugs string", "presumed_etiology_other string", "presumed_etiology_other_2 string", "presumed_etiology_unknown string", "presumed_etiology_diagnosis_date date", "diagnosis_chf string", "diagnosis_date_chf date", "diagnosis_hypertension string", "diagnosis_date_hypertension date", "diagnosis_diabetes string", "diagnosis_date_diabetes date", "diagnosis_other string", "diagnosis_date_other date", "hiv_status string", "hiv_test_date date", "art_start_date date", "tb_status string", "tb_date date", "history_of_dialysis string", "date_of_dialysis date"),
)

FORM_TABLES['mw_diabetes_hypertension_followup'] = dict(
    id_col='followup_visit_id',
    types=('DIABETES HYPERTENSION FOLLOWUP',),
    columns=(
        C('alcohol', 'History of alcohol use', 'value_coded'),
        C('ccb_aml', None, 'value_coded', answer='Amlodipine'),
        C('asprin_asa', None, 'value_coded', answer='Aspirin'),
        C('bb_aten', None, 'value_coded', answer='Atenolol'),
        C('statin_atorva', None, 'value_coded', answer='Atorvastatin'),
        C('bp_stystolic', 'Systolic blood pressure', 'value_numeric'),
        C('bb_bis', None, 'value_coded', answer='Bisoprolol'),
        C('blood_sugar_test_type', 'Blood sugar test type', 'value_coded'),
        C('body_mass_index', 'Body Mass Index, coded', 'value_coded'),
        C('ace_i_capt', None, 'value_coded', answer='Captopril'),
        C('cardiovascular_risk', 'Cardiovascular risk score', 'value_numeric'),
        C('days_per_week_with_30_min_of_exercise', 'Days per week of moderate exercise', 'value_numeric'),
        C('deformities', 'Deformity of foot', 'value_coded'),
        C('bp_diastolic', 'Diastolic blood pressure', 'value_numeric'),
        C('ace_i_enal', None, 'value_coded', answer='Enalapril'),
        C('fasting_blood_sugar', 'Serum glucose', 'value_numeric'),
        C('diuretic_furp', None, 'value_coded', answer='Furosemide'),
        C('diabetes_med_gilbenclamide', None, 'value_coded', answer='Glibenclamide'),
        C('hba1c', 'Glycated hemoglobin', 'value_numeric'),
        C('height', 'Height (cm)', 'value_numeric'),
        C('other_hyd', None, 'value_coded', answer='Hydralazine'),
        C('diuretic_hctz', None, 'value_coded', answer='Hydrochlorothiazide'),
        C('other_issmn', None, 'value_coded', answer='Isosorbide mononitrate'),
        C('ace_i_lisin', None, 'value_coded', answer='Lisinopril'),
        C('diabetes_med_long_acting', None, 'value_coded', answer='Long acting insulin'),
        C('diabetes_med_metformin', None, 'value_coded', answer='Metformin'),
        C('neuropathy_or_pvd', 'Neuropathy and Peripheral Vascular Disease', 'value_coded'),
        C('next_appointment_date', 'Appointment date', 'value_date'),
        C('ccb_nif', None, 'value_coded', answer='Nifedipine'),
        C('number_of_fruit_and_vegetable_portions', 'Number of servings of fruits and vegetables consumed per day', 'value_numeric'),
        C('hospitalized_since_last_visit', 'Patient hospitalized since last visit', 'value_coded'),
        C('statin_prava', None, 'value_coded', answer='Pravastatin'),
        C('bb_prop', None, 'value_coded', answer='Propranolol'),
        C('pulse_rate', 'Pulse', 'value_numeric'),
        C('diabetes_med_short_acting', None, 'value_coded', answer='Insulin, soluble'),
        C('statin_simva', None, 'value_coded', answer='Simvastatin'),
        C('diuretic_spiro', None, 'value_coded', answer='Spironolactone'),
        C('tobbacco', 'Smoking history', 'value_coded'),
        C('ulcers', 'Foot ulcer or infection', 'value_coded'),
        C('visual_acuity', 'Visual acuity (text)', 'value_text'),
        C('weight', 'Weight (kg)', 'value_numeric'),
    ),
    grouped=frozenset([]),
    untyped=frozenset(['ace_i_capt', 'ace_i_enal', 'ace_i_lisin', 'alcohol', 'asprin_asa', 'bb_aten', 'bb_bis', 'bb_prop', 'blood_sugar_test_type', 'body_mass_index', 'bp_diastolic', 'bp_stystolic', 'cardiovascular_risk', 'ccb_aml', 'ccb_nif', 'days_per_week_with_30_min_of_exercise', 'deformities', 'diabetes_med_gilbenclamide', 'diabetes_med_long_acting', 'diabetes_med_metformin', 'diabetes_med_short_acting', 'diuretic_furp', 'diuretic_hctz', 'diuretic_spiro', 'fasting_blood_sugar', 'hba1c', 'height', 'hospitalized_since_last_visit', 'neuropathy_or_pvd', 'next_appointment_date', 'number_of_fruit_and_vegetable_portions', 'other_hyd', 'other_issmn', 'pulse_rate', 'statin_atorva', 'statin_prava', 'statin_simva', 'tobbacco', 'ulcers', 'visual_acuity', 'weight']),
    ddl=("followup_visit_id long", "patient_id long", "visit_date date", "location string", "height decimal(10,2)", "weight decimal(10,2)", "body_mass_index string", "bp_stystolic long", "bp_diastolic long", "pulse_rate long", "hba1c decimal(10,2)", "fasting_blood_sugar decimal(10,2)", "blood_sugar_test_type string", "tobbacco string", "alcohol string", "number_of_fruit_and_vegetable_portions string", "days_per_week_with_30_min_of_exercise long", "cardiovascular_risk string", "visual_acuity string", "neuropathy_or_pvd string", "deformities string", "ulcers string", "hospitalized_since_last_visit string", "diabetes_med_long_acting string", "diabetes_med_short_acting string", "diabetes_med_metformin string", "diabetes_med_gilbenclamide string", "diuretic_hctz string", "diuretic_furp string", "diuretic_spiro string", "ccb_aml string", "ccb_nif string", "ace_i_enal string", "ace_i_capt string", "ace_i_lisin string", "bb_aten string", "bb_bis string", "bb_prop string", "asprin_asa string", "statin_simva string", "statin_prava string", "statin_atorva string", "other_hyd string", "other_issmn string", "next_appointment_date date"),
)

FORM_TABLES['mw_diabetes_hypertension_initial'] = dict(
    id_col='initial_visit_id',
    types=('DIABETES HYPERTENSION INITIAL VISIT',),
    columns=(
        C('art_start_date', 'Date antiretrovirals started', 'value_date'),
        C('cardiovascular_disease', None, 'value_coded', answer='Cardiovascular disease'),
        C('cardiovascular_disease_date', 'Diagnosis date', 'value_date'),
        C('family_history_diabetes_mellitus', 'Family History of Diabetes Mellitus', 'value_coded'),
        C('family_history_hypertension', 'Family history of hypertension', 'value_coded'),
        C('hiv_status', 'HIV status', 'value_coded'),
        C('hiv_test_date', 'HIV test date', 'value_date'),
        C('diagnosis_hypertension', None, 'value_coded', answer='Hypertension'),
        C('diagnosis_hypertension_date', 'Diagnosis date', 'value_date'),
        C('neuropathy', None, 'value_coded', answer='Neuropathy'),
        C('neuropathy_date', 'Diagnosis date', 'value_date'),
        C('peripheral_vascular_disease_date', 'Diagnosis date', 'value_date'),
        C('peripheral_vascular_disease', None, 'value_coded', answer='Peripheral vascular disease'),
        C('renal_disease', None, 'value_coded', answer='Renal disease'),
        C('renal_disease_date', 'Diagnosis date', 'value_date'),
        C('retinopathy', None, 'value_coded', answer='Retinopathy'),
        C('retinopathy_date', 'Diagnosis date', 'value_date'),
        C('sexual_disorder', None, 'value_coded', answer='Sexual Disorder'),
        C('sexual_disorder_date', 'Diagnosis date', 'value_date'),
        C('stroke_and_tia_date', 'Diagnosis date', 'value_date'),
        C('stroke_and_tia', None, 'value_coded', answer='Stroke and Transient Ischemic Attack'),
        C('tb_status', 'TB status', 'value_coded'),
        C('tb_status_year', 'Year of Tuberculosis diagnosis', 'value_numeric'),
        C('diagnosis_type_1_diabetes', None, 'value_coded', answer='Type 1 diabetes'),
        C('diagnosis_type_1_diabetes_date', 'Diagnosis date', 'value_date'),
        C('diagnosis_type_2_diabetes', None, 'value_coded', answer='Type 2 diabetes'),
        C('diagnosis_type_2_diabetes_date', 'Diagnosis date', 'value_date'),
    ),
    grouped=frozenset([]),
    untyped=frozenset(['art_start_date', 'cardiovascular_disease', 'cardiovascular_disease_date', 'diagnosis_hypertension', 'diagnosis_hypertension_date', 'diagnosis_type_1_diabetes', 'diagnosis_type_1_diabetes_date', 'diagnosis_type_2_diabetes', 'diagnosis_type_2_diabetes_date', 'family_history_diabetes_mellitus', 'family_history_hypertension', 'hiv_status', 'hiv_test_date', 'neuropathy', 'neuropathy_date', 'peripheral_vascular_disease', 'peripheral_vascular_disease_date', 'renal_disease', 'renal_disease_date', 'retinopathy', 'retinopathy_date', 'sexual_disorder', 'sexual_disorder_date', 'stroke_and_tia', 'stroke_and_tia_date', 'tb_status', 'tb_status_year']),
    ddl=("initial_visit_id long", "patient_id long", "visit_date date", "location string", "diagnosis_type_1_diabetes string", "diagnosis_type_1_diabetes_date date", "diagnosis_type_2_diabetes string", "diagnosis_type_2_diabetes_date date", "diagnosis_hypertension string", "diagnosis_hypertension_date date", "hiv_status string", "hiv_test_date date", "art_start_date date", "cardiovascular_disease string", "cardiovascular_disease_date date", "retinopathy string", "retinopathy_date date", "renal_disease string", "renal_disease_date date", "family_history_diabetes_mellitus string", "family_history_hypertension string", "tb_status string", "tb_status_year string", "stroke_and_tia string", "stroke_and_tia_date date", "peripheral_vascular_disease string", "peripheral_vascular_disease_date date", "neuropathy string", "neuropathy_date date", "sexual_disorder string", "sexual_disorder_date date"),
)

FORM_TABLES['mw_eid_followup'] = dict(
    id_col='eid_followup_visit_id',
    types=('EXPOSED_CHILD_FOLLOWUP',),
    columns=(
        C('breast_feeding', 'Breast feeding', 'value_coded'),
        C('clinical_monitoring', 'Clinical Monitoring Exposed Child', 'value_coded'),
        C('mother_status', 'Mother HIV Status', 'value_coded'),
        C('next_appointment_date', 'Appointment date', 'value_date'),
        C('wasting_or_malnutrition', 'Wasting/malnutrition', 'value_coded'),
        C('cpt', 'Number of CPT tablets dispensed', 'value_numeric'),
        C('hiv_infection', 'Childs current HIV status', 'value_coded'),
        C('muac', 'Middle upper arm circumference (cm)', 'value_numeric'),
    ),
    grouped=frozenset([]),
    untyped=frozenset([]),
    ddl=("eid_followup_visit_id long", "patient_id long", "visit_date date", "location string", "muac double", "wasting_or_malnutrition string", "breast_feeding string", "mother_status string", "clinical_monitoring string", "hiv_infection string", "cpt long", "next_appointment_date date"),
)

FORM_TABLES['mw_eid_initial'] = dict(
    id_col='eid_initial_visit_id',
    types=('EXPOSED_CHILD_INITIAL',),
    columns=(
        C('age', 'Age', 'value_numeric'),
        C('age_when_starting_nvp', 'Patient age when result to guardian', 'value_numeric', group='Age at start of Neviripine construct'),
        C('birth_weight', 'Birth weight', 'value_numeric'),
        C('duration_type_when_starting_nvp', 'Units of age of child', 'value_coded', group='Age at start of Neviripine construct'),
        C('mother_art_reg_no', 'Mother ART registration number', 'value_text'),
        C('mother_art_start_date', 'Mother art start date', 'value_date'),
        C('mother_hiv_status', 'Mother HIV Status', 'value_coded'),
        C('nvp_duration', 'Medication duration', 'value_numeric'),
        C('nvp_duration_type', 'Time units', 'value_coded'),
    ),
    grouped=frozenset(['age_when_starting_nvp', 'duration_type_when_starting_nvp', 'nvp_duration', 'nvp_duration_type']),
    untyped=frozenset([]),
    ddl=("eid_initial_visit_id long", "patient_id long", "visit_date date", "location string", "mother_hiv_status string", "mother_art_reg_no string", "mother_art_start_date date", "age long", "age_when_starting_nvp long", "duration_type_when_starting_nvp string", "nvp_duration long", "nvp_duration_type string", "birth_weight decimal(10,2)"),
)

FORM_TABLES['mw_eid_visits'] = dict(
    id_col='eid_visit_id',
    types=('EXPOSED_CHILD_INITIAL', 'EXPOSED_CHILD_FOLLOWUP'),
    columns=(
        C('next_appointment_date', 'Appointment date', 'value_date'),
        C('breastfeeding_status', 'Breast feeding', 'value_coded'),
        C('mother_status', 'Mother HIV Status', 'value_coded'),
    ),
    grouped=frozenset([]),
    untyped=frozenset(['breastfeeding_status', 'mother_status', 'next_appointment_date']),
    ddl=("eid_visit_id long", "patient_id long", "visit_date date", "location string", "breastfeeding_status string", "mother_status string", "next_appointment_date date"),
)

FORM_TABLES['mw_epilepsy_followup'] = dict(
    id_col='epilepsy_followup_visit_id',
    types=('EPILEPSY_FOLLOWUP',),
    columns=(
        C('any_triggers', 'Any seizure triggers present', 'value_coded'),
        C('family_planning', 'Family planning', 'value_coded'),
        C('height', 'Height (cm)', 'value_numeric'),
        C('hospitalized_since_last_visit', 'Patient hospitalized since last visit', 'value_coded'),
        C('med_carbamazepine', 'Current drugs used', 'value_coded', answer='Carbamazepine'),
        C('number_of_seizures', 'NUMBER OF SEIZURES', 'value_numeric'),
        C('pregnant', 'Is patient pregnant?', 'value_coded'),
        C('silent_makers', 'Symptoms during seizure', 'value_coded'),
        C('alcohol_trigger', 'Epilepsy trigger', 'value_coded', answer='Alcohol trigger'),
        C('bmi', 'Body Mass Index, coded', 'value_coded'),
        C('emotional_stress_anger_boredom_trigger', 'Epilepsy trigger', 'value_coded', answer='Emotional stress, anger, boredom'),
        C('fever_trigger', 'Epilepsy trigger', 'value_coded', answer='Fever trigger'),
        C('menstruation_trigger', 'Epilepsy trigger', 'value_coded', answer='Menstruation trigger'),
        C('missed_medication_trigger', 'Epilepsy trigger', 'value_coded', answer='Missed medication trigger'),
        C('seizure_since_last_visit', 'Any seizure occurred since last visit', 'value_coded'),
        C('sleep_deprivation_and_overtired_trigger', 'Epilepsy trigger', 'value_coded', answer='Sleep deprivation and overtired'),
        C('sound_light_and_touch_trigger', 'Epilepsy trigger', 'value_coded', answer='Sound, light, and touch'),
        C('weight', 'Weight (kg)', 'value_numeric'),
        C('comments', 'Clinical impression comments', 'value_text'),
        C('med_Phenobarbital', 'Current drugs used', 'value_coded', answer='Phenobarbital'),
        C('med_Phenytoin', 'Current drugs used', 'value_coded', answer='Phenytoin'),
        C('med_Sodium_Valproate', 'Current drugs used', 'value_coded', answer='Sodium valproate'),
        C('med_other', 'Current drugs used', 'value_coded', answer='Other'),
        C('next_appointment_date', 'Appointment date', 'value_date'),
    ),
    grouped=frozenset([]),
    untyped=frozenset([]),
    ddl=("epilepsy_followup_visit_id long", "patient_id long", "visit_date date", "location string", "height long", "weight long", "bmi string", "seizure_since_last_visit string", "number_of_seizures long", "any_triggers string", "alcohol_trigger string", "fever_trigger string", "sound_light_and_touch_trigger string", "emotional_stress_anger_boredom_trigger string", "sleep_deprivation_and_overtired_trigger string", "missed_medication_trigger string", "menstruation_trigger string", "silent_makers string", "hospitalized_since_last_visit string", "pregnant string", "family_planning string", "med_carbamazepine string", "med_Phenobarbital string", "med_Phenytoin string", "med_Sodium_Valproate string", "med_other string", "comments string", "next_appointment_date date"),
)

FORM_TABLES['mw_epilepsy_initial'] = dict(
    id_col='epilepsy_initial_visit_id',
    types=('EPILEPSY_INITIAL',),
    columns=(
        C('alcohol_date_of_exposure', 'Date of exposure', 'value_date'),
        C('alcohol_exposure', 'Exposure', 'value_coded', answer='Alcohol'),
        C('alcohol_trigger', 'Alcohol trigger', 'value_coded'),
        C('art_start_date', 'Date antiretrovirals started', 'value_date'),
        C('behavioral_family_history', 'Family history of behavioral problems', 'value_coded'),
        C('burn_complication', 'Epilepsy complications', 'value_coded', answer='Burn'),
        C('complications_at_birth', 'Complications at birth', 'value_coded'),
        C('date_of_burn_complication', 'Date of complication', 'value_date'),
        C('date_of_injury_complication', 'Date of complication', 'value_date'),
        C('date_of_psychosis_complication', 'Date of complication', 'value_date'),
        C('date_of_status_epilepticus_complication', 'Date of complication', 'value_date'),
        C('delayed_milestones', 'Delayed milestones', 'value_coded'),
        C('drug_related_complication', 'Epilepsy complications', 'value_coded', answer='Side effects of treatment'),
        C('drug_related_complication_date', 'Date of complication', 'value_date'),
        C('education_level', 'Highest level of school completed', 'value_coded'),
        C('emotional_stress_anger_boredom_trigger', 'Emotional stress, anger, boredom', 'value_coded'),
        C('epilepsy_family_history', 'Family history of epilepsy', 'value_coded'),
        C('fever_trigger', 'Fever trigger', 'value_coded'),
        C('head_trauma_injury_surgery', 'Injury, trauma, surgery of head', 'value_coded'),
        C('history_of_seizure', 'History of seizure', 'value_coded'),
        C('hiv_status', 'HIV status', 'value_coded'),
        C('hiv_test_date', 'HIV test date', 'value_date'),
        C('injury_complication', 'Epilepsy complications', 'value_coded', answer='Injury'),
        C('marital_status', 'Civil status', 'value_coded'),
        C('medication_history', 'Medication history (text)', 'value_text'),
        C('menstruation_trigger', 'Menstruation trigger', 'value_coded'),
        C('mental_health_family_history', 'Family history of mental illness', 'value_coded'),
        C('missed_medication_trigger', 'Missed medication trigger', 'value_coded'),
        C('month_of_onset', 'Month of onset', 'value_numeric'),
        C('neonatal_infection_cerebral_malaria_meningitis', 'Neonatal infection, Cerebral Malaria, and/or Meningitis', 'value_coded'),
        C('occupation', 'Main activity', 'value_coded'),
        C('other_complication', 'Epilepsy complications', 'value_coded', answer='Other'),
        C('other_complication_date', 'Date of complication', 'value_date'),
        C('pig_date_of_exposure', 'Date of exposure', 'value_date'),
        C('pig_exposure', 'Exposure', 'value_coded', answer='Pig'),
        C('post_ictal_disorientation', 'Post-ictal disorientation', 'value_coded'),
        C('post_ictal_drowsiness', 'Post-ictal drowsiness', 'value_coded'),
        C('post_ictal_headache', 'Post-ictal headache', 'value_coded'),
        C('post_ictal_hyperactivity', 'Post-ictal hyperactivity', 'value_coded'),
        C('post_ictal_memory_loss', 'Post-ictal memory loss', 'value_coded'),
        C('post_ictal_nausea', 'Post-ictal nausea', 'value_coded'),
        C('post_ictal_paralysis', 'Post-ictal paralysis', 'value_coded'),
        C('post_ictal_poor_concentration', 'Post-ictal poor concentration', 'value_coded'),
        C('post_ictal_poor_verbal_or_cognition', 'Post-ictal poor verbal or cognition', 'value_coded'),
        C('pre_ictal_warning', 'Pre-ictal warning', 'value_coded'),
        C('psychosis_complication', 'Epilepsy complications', 'value_coded', answer='Injury'),
        C('seizure_type_absence', 'Absence seizures', 'value_coded'),
        C('seizure_type_atonic', 'Atonic seizures', 'value_coded'),
        C('seizure_type_clonic', 'Clonic seizures', 'value_coded'),
        C('seizure_type_complex', 'Complex partial seizure', 'value_coded'),
        C('seizure_type_myoclonic', 'Myoclonic seizures', 'value_coded'),
        C('seizure_type_simple', 'Simple partial seizure', 'value_coded'),
        C('seizure_type_tonic', 'Tonic seizures', 'value_coded'),
        C('seizure_type_tonic_clonic', 'Seizures grandmal', 'value_coded'),
        C('seizure_type_unclassified', 'Unclassified epileptic seizures', 'value_coded'),
        C('sleep_deprivation_and_overtired_trigger', 'Sleep deprivation and overtired', 'value_coded'),
        C('smoking_date_of_exposure', 'Date of exposure', 'value_date'),
        C('smoking_exposure', 'Exposure', 'value_coded', answer='Smoking'),
        C('sound_light_and_touch_trigger', 'Sound, light, and touch', 'value_coded'),
        C('status_epilepticus_complication', 'Epilepsy complications', 'value_coded', answer='Status epilepticus'),
        C('traditional_medicine_date_of_exposure', 'Date of exposure', 'value_date'),
        C('traditional_medicine_exposure', 'Exposure', 'value_coded', answer='Traditional medicine'),
        C('vdrl', 'Vdrl', 'value_coded'),
        C('year_of_onset', 'Year of onset', 'value_numeric'),
        C('age_at_onset', 'Age of epilepsy diagnosis', 'value_numeric'),
    ),
    grouped=frozenset(['alcohol_date_of_exposure', 'alcohol_exposure', 'burn_complication', 'date_of_burn_complication', 'date_of_injury_complication', 'date_of_psychosis_complication', 'date_of_status_epilepticus_complication', 'drug_related_complication', 'drug_related_complication_date', 'injury_complication', 'other_complication', 'other_complication_date', 'pig_date_of_exposure', 'pig_exposure', 'psychosis_complication', 'smoking_date_of_exposure', 'smoking_exposure', 'status_epilepticus_complication', 'traditional_medicine_date_of_exposure', 'traditional_medicine_exposure']),
    untyped=frozenset([]),
    ddl=("epilepsy_initial_visit_id long", "patient_id long", "visit_date date", "location string", "seizure_type_tonic_clonic string", "seizure_type_clonic string", "seizure_type_simple string", "seizure_type_absence string", "seizure_type_tonic string", "seizure_type_complex string", "seizure_type_myoclonic string", "seizure_type_atonic string", "seizure_type_unclassified string", "epilepsy_family_history string", "mental_health_family_history string", "behavioral_family_history string", "hiv_status string", "hiv_test_date date", "art_start_date date", "vdrl string", "month_of_onset long", "year_of_onset long", "age_at_onset long", "marital_status string", "occupation string", "education_level string", "medication_history string", "pre_ictal_warning string", "post_ictal_headache string", "post_ictal_drowsiness string", "post_ictal_poor_concentration string", "post_ictal_poor_verbal_or_cognition string", "post_ictal_paralysis string", "post_ictal_disorientation string", "post_ictal_nausea string", "post_ictal_memory_loss string", "post_ictal_hyperactivity string", "head_trauma_injury_surgery string", "history_of_seizure string", "complications_at_birth string", "neonatal_infection_cerebral_malaria_meningitis string", "delayed_milestones string", "alcohol_trigger string", "fever_trigger string", "sound_light_and_touch_trigger string", "emotional_stress_anger_boredom_trigger string", "sleep_deprivation_and_overtired_trigger string", "missed_medication_trigger string", "menstruation_trigger string", "smoking_exposure string", "smoking_date_of_exposure date", "alcohol_exposure string", "alcohol_date_of_exposure date", "pig_exposure string", "pig_date_of_exposure date", "traditional_medicine_exposure string", "traditional_medicine_date_of_exposure string", "injury_complication string", "date_of_injury_complication date", "burn_complication string", "date_of_burn_complication date", "status_epilepticus_complication string", "date_of_status_epilepticus_complication date", "psychosis_complication string", "date_of_psychosis_complication date", "drug_related_complication string", "drug_related_complication_date date", "other_complication string", "other_complication_date date"),
)

FORM_TABLES['mw_mental_health_followup'] = dict(
    id_col='mental_health_followup_visit_id',
    types=('MENTAL_HEALTH_FOLLOWUP',),
    columns=(
        C('able_to_do_daily_activities', 'Able to perform daily activities', 'value_coded'),
        C('current_use_alcohol', 'History of alcohol use', 'value_coded'),
        C('current_use_marijuana', None, 'value_coded', group='Marijuana use construct'),
        C('current_use_other', None, 'value_coded', group='Drug use construct'),
        C('mse_depressed_mood', 'Mental health chief complaint absent', 'value_coded', answer='Depressive Disorder'),
        C('mse_disorganized_speech', 'Mental health chief complaint absent', 'value_coded', answer='Abnormal speech'),
        C('mse_disruptive_behaviour', 'Mental health chief complaint absent', 'value_coded', answer='Disruptive Behavior Disorder'),
        C('mse_elevated_mood', 'Mental health chief complaint absent', 'value_coded', answer='Hypomania'),
        C('mse_Lack_of_insight', 'Mental health chief complaint absent', 'value_coded', answer='Lack of insight'),
        C('mse_delusions', 'Mental health chief complaint absent', 'value_coded', answer='Delusions'),
        C('mse_hallucinations', 'Mental health chief complaint absent', 'value_coded', answer='Hallucinations'),
        C('mse_other', 'Mental health chief complaint absent', 'value_coded', answer='Other non-coded'),
        C('on_family_planning', 'Family planning', 'value_coded'),
        C('patient_stable', 'Stable', 'value_coded'),
        C('suicide_risk', 'Suicide risk', 'value_coded'),
        C('comments', 'Clinical impression comments', 'value_text'),
        C('height', 'Height (cm)', 'value_numeric'),
        C('pregnant', 'Is patient pregnant?', 'value_coded'),
        C('weight', 'Weight (kg)', 'value_numeric'),
        C('hospitalized_since_last_visit', 'Hospitalized for mental health since last visit', 'value_coded'),
        C('med_carbamazepine', 'Current drugs used', 'value_coded', answer='Carbamazepine'),
        C('med_chloropromazine', 'Current drugs used', 'value_coded', answer='Chlorpromazine'),
        C('med_clopixol', 'Current drugs used', 'value_coded', answer='Clopixol'),
        C('med_clozapine', 'Current drugs used', 'value_coded', answer='Clozapine'),
        C('med_fluoxetine', 'Current drugs used', 'value_coded', answer='Fluoxetine'),
        C('med_fluphenazine', 'Current drugs used', 'value_coded', answer='Fluphenazine'),
        C('med_haloperidol', 'Current drugs used', 'value_coded', answer='Haloperidol'),
        C('med_olanzapine', 'Current drugs used', 'value_coded', answer='Olanzapine'),
        C('med_risperidone', 'Current drugs used', 'value_coded', answer='Risperidone'),
        C('med_sodium_valproate', 'Current drugs used', 'value_coded', answer='Sodium valproate'),
        C('med_trifluoperazine', 'Current drugs used', 'value_coded', answer='Trifluoperazine'),
        C('med_other', None, 'value_coded', answer='Other', group='Current Chronic Care Medication Construct'),
        C('medications_side_effects', 'Does patient have adverse effects', 'value_coded'),
        C('next_appointment_date', 'Appointment date', 'value_date'),
    ),
    grouped=frozenset([]),
    untyped=frozenset([]),
    ddl=("mental_health_followup_visit_id long", "patient_id long", "visit_date date", "location string", "height long", "weight long", "mse_depressed_mood string", "mse_elevated_mood string", "mse_disruptive_behaviour string", "mse_disorganized_speech string", "mse_delusions string", "mse_hallucinations string", "mse_Lack_of_insight string", "mse_other string", "patient_stable string", "able_to_do_daily_activities string", "current_use_marijuana string", "current_use_alcohol string", "current_use_other string", "pregnant string", "on_family_planning string", "suicide_risk string", "medications_side_effects string", "hospitalized_since_last_visit string", "med_chloropromazine string", "med_haloperidol string", "med_risperidone string", "med_fluphenazine string", "med_carbamazepine string", "med_sodium_valproate string", "med_fluoxetine string", "med_olanzapine string", "med_clozapine string", "med_trifluoperazine string", "med_clopixol string", "med_other string", "comments string", "next_appointment_date date"),
)

FORM_TABLES['mw_ncd_other_followup'] = dict(
    id_col='ncd_other_followup_visit_id',
    types=('NCD_OTHER_FOLLOWUP',),
    columns=(
        C('alcohol', 'History of alcohol use', 'value_coded'),
        C('bp_diastolic', 'Diastolic blood pressure', 'value_numeric'),
        C('bp_systolic', 'Systolic blood pressure', 'value_numeric'),
        C('comments', 'General comment', 'value_text'),
        C('days_per_week_exercise', 'Days per week of moderate exercise', 'value_numeric'),
        C('fruit_and_vegetable_portions', 'Number of servings of fruits and vegetables consumed per day', 'value_numeric'),
        C('heart_rate', 'Pulse', 'value_numeric'),
        C('height', 'Height (cm)', 'value_numeric'),
        C('hospitalized_since_last_visit_for_ncd', 'Hospitalized for non-communicable disease since last visit', 'value_coded'),
        C('medications', 'Medications dispensed', 'value_text'),
        C('medications_changed', 'Has the treatment changed at this visit?', 'value_coded'),
        C('next_appointment_date', 'Appointment date', 'value_date'),
        C('next_appointment_location', 'Next appointment location', 'value_coded'),
        C('spo2', 'Blood oxygen saturation', 'value_numeric'),
        C('tobacco', 'Smoking history', 'value_coded'),
        C('weight', 'Weight (kg)', 'value_numeric'),
        C('weight_change', 'Weight change', 'value_text'),
    ),
    grouped=frozenset([]),
    untyped=frozenset([]),
    ddl=("ncd_other_followup_visit_id long", "patient_id long", "visit_date date", "location string", "height long", "weight long", "weight_change string", "bp_systolic long", "bp_diastolic long", "heart_rate long", "spo2 long", "alcohol string", "tobacco string", "fruit_and_vegetable_portions long", "days_per_week_exercise long", "hospitalized_since_last_visit_for_ncd string", "medications string", "medications_changed string", "comments string", "next_appointment_date date", "next_appointment_location string"),
)

FORM_TABLES['mw_ncd_other_initial'] = dict(
    id_col='ncd_other_initial_visit_id',
    types=('NCD_OTHER_INITIAL',),
    columns=(
        C('art_start_date', 'Date antiretrovirals started', 'value_date'),
        C('comorbidities_chronic_kidney_disease', 'Current opportunistic infection or comorbidity, confirmed or presumed', 'value_coded', answer='Chronic kidney disease'),
        C('comorbidities_diabetes', 'Current opportunistic infection or comorbidity, confirmed or presumed', 'value_coded', answer='Diabetes'),
        C('comorbidities_hypertension', 'Current opportunistic infection or comorbidity, confirmed or presumed', 'value_coded', answer='Hypertension'),
        C('comorbidities_other', 'Other diagnosis', 'value_text'),
        C('diagnosis_cirrhosis', 'Chronic care diagnosis', 'value_coded', answer='Restrictive cardiomyopathy'),
        C('diagnosis_date_other', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_cirrhosis', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_dvt_or_pe', 'Diagnosis date', 'value_date'),
        C('diagnosis_date_rheumatoid_arthritis', 'Diagnosis date', 'value_date'),
        C('diagnosis_dvt_or_pe', 'Chronic care diagnosis', 'value_coded', answer='Deep vein thrombosis'),
        C('diagnosis_other', 'Other diagnosis', 'value_text'),
        C('diagnosis_rheumatoid_arthritis', 'Chronic care diagnosis', 'value_coded', answer='Rheumatoid arthritis'),
        C('diagnosis_sickle_cell_disease', 'Chronic care diagnosis', 'value_coded', answer='Sickle cell disease'),
        C('ecg_test_date', 'Date of general test', 'value_date'),
        C('ecg_test_result', 'Electrocardiogram diagnosis', 'value_coded'),
        C('echo_test_date', 'Date of general test', 'value_date'),
        C('echo_test_result', 'ECHO imaging result', 'value_text'),
        C('hiv_status', 'HIV status', 'value_coded'),
        C('hiv_test_date', 'HIV test date', 'value_date'),
        C('tb_start_date', 'Tuberculosis diagnosis date', 'value_date'),
        C('tb_status', 'TB status', 'value_coded'),
    ),
    grouped=frozenset(['diagnosis_cirrhosis', 'diagnosis_date_cirrhosis', 'diagnosis_date_dvt_or_pe', 'diagnosis_date_other', 'diagnosis_date_rheumatoid_arthritis', 'diagnosis_dvt_or_pe', 'diagnosis_other', 'diagnosis_rheumatoid_arthritis', 'diagnosis_sickle_cell_disease', 'ecg_test_date', 'ecg_test_result', 'echo_test_date', 'echo_test_result']),
    untyped=frozenset([]),
    ddl=("ncd_other_initial_visit_id long", "patient_id long", "visit_date date", "location string", "diagnosis_rheumatoid_arthritis string", "diagnosis_date_rheumatoid_arthritis date", "diagnosis_cirrhosis string", "diagnosis_date_cirrhosis date", "diagnosis_dvt_or_pe string", "diagnosis_date_dvt_or_pe date", "diagnosis_sickle_cell_disease string", "diagnosis_other string", "diagnosis_date_other date", "hiv_status string", "hiv_test_date date", "art_start_date date", "tb_status string", "tb_start_date date", "comorbidities_hypertension string", "comorbidities_diabetes string", "comorbidities_chronic_kidney_disease string", "comorbidities_other string", "echo_test_result string", "echo_test_date date", "ecg_test_result string", "ecg_test_date date"),
)

FORM_TABLES['mw_pre_art_visits'] = dict(
    id_col='pre_art_visit_id',
    types=('PART_INITIAL', 'PART_FOLLOWUP'),
    columns=(
        C('next_appointment_date', 'Appointment date', 'value_date'),
    ),
    grouped=frozenset([]),
    untyped=frozenset(['next_appointment_date']),
    ddl=("pre_art_visit_id long", "patient_id long", "visit_date date", "location string", "next_appointment_date date"),
)
