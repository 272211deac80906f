"""Column lists and schemas of flows, scored flows, alerts and result tables."""

from pyspark.sql import types as T

# The 41 features of the public flow dataset, in file order.
FLOW_FIELDS = [
    ("duration", "double"),
    ("protocol_type", "string"),
    ("service", "string"),
    ("flag", "string"),
    ("src_bytes", "double"),
    ("dst_bytes", "double"),
    ("land", "int"),
    ("wrong_fragment", "int"),
    ("urgent", "int"),
    ("hot", "int"),
    ("num_failed_logins", "int"),
    ("logged_in", "int"),
    ("num_compromised", "int"),
    ("root_shell", "int"),
    ("su_attempted", "int"),
    ("num_root", "int"),
    ("num_file_creations", "int"),
    ("num_shells", "int"),
    ("num_access_files", "int"),
    ("num_outbound_cmds", "int"),
    ("is_host_login", "int"),
    ("is_guest_login", "int"),
    ("count", "int"),
    ("srv_count", "int"),
    ("serror_rate", "double"),
    ("srv_serror_rate", "double"),
    ("rerror_rate", "double"),
    ("srv_rerror_rate", "double"),
    ("same_srv_rate", "double"),
    ("diff_srv_rate", "double"),
    ("srv_diff_host_rate", "double"),
    ("dst_host_count", "int"),
    ("dst_host_srv_count", "int"),
    ("dst_host_same_srv_rate", "double"),
    ("dst_host_diff_srv_rate", "double"),
    ("dst_host_same_src_port_rate", "double"),
    ("dst_host_srv_diff_host_rate", "double"),
    ("dst_host_serror_rate", "double"),
    ("dst_host_srv_serror_rate", "double"),
    ("dst_host_rerror_rate", "double"),
    ("dst_host_srv_rerror_rate", "double"),
]
CATEGORICAL = ["protocol_type", "service", "flag"]
NORMAL_LABEL = "normal"
# Decision names, in code order 0, 1, 2.
DECISIONS = ["NORMAL", "ATTACK", "SUSPICIOUS"]
ALERT_DECISIONS = ["ATTACK", "SUSPICIOUS"]
# Tuned cuts of the published final configuration.
RF_THRESHOLD = 0.40
IF_THRESHOLD = -0.10
# Candidate cuts of the three threshold experiments.
PROBABILITY_CUTS = [0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50]
ANOMALY_CUTS = [-0.10, -0.05, 0.00, 0.05, 0.10, 0.15, 0.20]
HYBRID_CUTS = [-0.15, -0.10, -0.05, 0.00, 0.05, 0.10]

FEATURES = [name for name, _ in FLOW_FIELDS]
NUMERIC = [name for name in FEATURES if name not in CATEGORICAL]


_TYPES = {
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}


def _struct(fields):
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


FLOW_SCHEMA = _struct(FLOW_FIELDS)
RAW_SCHEMA = _struct(FLOW_FIELDS + [("label", "string"), ("difficulty", "int")])
PREPARED_SCHEMA = _struct(
    [("flow_id", "string")] + FLOW_FIELDS + [("label", "string"), ("target", "int")]
)
SCORE_FIELDS = [
    ("decision", "string"),
    ("rf_probability", "double"),
    ("rf_prediction", "boolean"),
    ("if_score", "double"),
    ("if_anomaly", "boolean"),
]
# flow_id is the unique key; id is the numeric handle shown to readers.
STREAMED_SCHEMA = _struct([("flow_id", "string"), *FLOW_FIELDS, *SCORE_FIELDS, ("batch_id", "bigint")])
ALERT_SCHEMA = _struct(
    [
        ("id", "bigint"),
        ("decision", "string"),
        ("rf_probability", "double"),
        ("if_score", "double"),
        ("rf_prediction", "boolean"),
        ("if_anomaly", "boolean"),
        ("created_at", "timestamp"),
        ("flow_id", "string"),
    ]
)

_TYPE_ROWS = "attack_type string, total bigint, detected bigint, missed bigint, recall double"
_GROUP_ROWS = (
    "group string, samples bigint, rf_recall double, if_recall double, hybrid_recall double, "
    "rf_f1 double, if_f1 double, hybrid_f1 double"
)
_FINAL_GROUP_ROWS = (
    "group string, samples bigint, detected bigint, missed bigint, precision double, "
    "recall double, f1 double, suspicious bigint"
)
_MODEL_ROWS = "model string, accuracy double, precision double, recall double, f1 double"
# Names and columns of the stored result tables.
RESULT_SCHEMAS = {
    "attack_distribution_report": (
        "label string, train_count bigint, test_count bigint, seen_in_training boolean, "
        "test_only boolean, train_percentage double, test_percentage double"
    ),
    "shared_attack_evaluation": _TYPE_ROWS,
    "unseen_attack_evaluation": _TYPE_ROWS,
    "anomaly_shared_attack_evaluation": _TYPE_ROWS,
    "anomaly_unseen_attack_evaluation": _TYPE_ROWS,
    "rf_vs_if_model_comparison": (
        "model string, threshold double, accuracy double, precision double, recall double, "
        "f1 double"
    ),
    "rf_vs_if_group_comparison": (
        "group string, samples bigint, rf_recall double, rf_f1 double, if_recall double, "
        "if_f1 double"
    ),
    "rf_vs_if_attack_comparison": (
        "attack_type string, group string, total bigint, rf_detected bigint, rf_missed bigint, "
        "rf_recall double, if_detected bigint, if_missed bigint, if_recall double"
    ),
    "hybrid_attack_analysis": (
        "attack_type string, group string, total bigint, rf_detected bigint, rf_recall double, "
        "if_detected bigint, if_recall double, hybrid_detected bigint, hybrid_recall double, "
        "suspicious bigint"
    ),
    "hybrid_group_comparison": _GROUP_ROWS,
    "hybrid_threshold_experiment": (
        "if_threshold double, accuracy double, precision double, recall double, f1 double, "
        "shared_recall double, test_only_recall double, suspicious_total bigint, "
        "suspicious_attacks bigint, suspicious_normals bigint"
    ),
    "final_model_comparison": _MODEL_ROWS,
    "final_hybrid_attack_analysis": (
        "attack_type string, total bigint, rf_detected bigint, rf_recall double, "
        "if_detected bigint, if_recall double, hybrid_detected bigint, hybrid_missed bigint, "
        "hybrid_recall double, suspicious bigint"
    ),
    "final_hybrid_group_comparison": _GROUP_ROWS,
    "final_ids_analysis": (
        "accuracy double, attack_precision double, attack_recall double, attack_f1 double, "
        "total_samples bigint, normal_samples bigint, attack_samples bigint, "
        "normal_decisions bigint, attack_decisions bigint, suspicious_decisions bigint, "
        "suspicious_true_attacks bigint, suspicious_true_normals bigint"
    ),
    "final_ids_validation": (
        "accuracy double, precision double, recall double, f1 double, normal bigint, "
        "attack bigint, suspicious bigint"
    ),
    "final_performance_summary": _MODEL_ROWS,
    "final_ids_attack_type_analysis": (
        "attack_type string, total bigint, detected bigint, missed bigint, recall double, "
        "suspicious bigint"
    ),
    "final_ids_group_analysis": _FINAL_GROUP_ROWS,
}
