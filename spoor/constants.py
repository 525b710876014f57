"""Fixed values of the data model and the message format."""

# Operation types of the supported write commands.
OPERATION_TYPES = {
    "CreateHiveTableAsSelectCommand": "CREATETABLE_AS_SELECT",
    "InsertIntoHiveTable": "INSERT_INTO_HIVE_TABLE",
    "CreateDataSourceTableAsSelectCommand": "CREATETABLE_AS_SELECT",
}
HIVE_CTAS = "CreateHiveTableAsSelectCommand"
HIVE_INSERT = "InsertIntoHiveTable"
DATASOURCE_CTAS = "CreateDataSourceTableAsSelectCommand"

# Plan node and relation classes.
UNION_NODE = "UnionExec"
WRITE_NODE = "DataWritingCommandExec"
V2_WRITE_NODE = "WriteToDataSourceV2Exec"
LEAF_NODE = "LeafExecNode"
HIVE_RELATION = "HiveTableRelation"
PROJECT_ROOT = "Project"

# Names.
DEFAULT_NAMESPACE = "5k"
DEFAULT_INPUT_DATABASE = "default"
QUERY_PREFIX = "QUERY:"
OVERWRITE = "INSERT_OVERWRITE"
INSERT = "INSERT"
SIMPLE = "SIMPLE"
EXPRESSION = "EXPRESSION"

# Entity and relationship types, entity attributes.
PROCESS_TYPE = "hive_process"
COLUMN_LINEAGE_TYPE = "hive_column_lineage"
TABLE_TYPE = "hive_table"
COLUMN_TYPE = "hive_column"
INPUTS_RELATIONSHIP = "dataset_process_inputs"
OUTPUTS_RELATIONSHIP = "process_dataset_outputs"
COLUMN_LINEAGE_RELATIONSHIP = "hive_process_column_lineage"
PROCESS_USER = "Spark"
QUERY_PLAN = "Not Supported"

# Messages.
NOTIFICATION_TYPE = "ENTITY_CREATE_V2"
MESSAGE_VERSION = "1.0.0"
MESSAGE_VERSION_PARTS = (1,)
MAX_MESSAGE_BYTES = 1000 * 1000 - 512
MAX_BYTES_PER_CHAR = 4
GZIP = "GZIP"
NONE = "NONE"

# Publishing.
NAMESPACE_OPTION = "atlas.cluster.name"
TOPIC_OPTION = "atlas.hook.topic"
DEFAULT_TOPIC = "ATLAS_HOOK"
KAFKA_OPTION_PREFIX = "atlas.kafka."
SESSION_TIMEOUT_MS = "30000"
PUBLISH_ATTEMPTS = 3
RETRY_WAIT_MS = 3000
