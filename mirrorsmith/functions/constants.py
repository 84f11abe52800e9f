"""Fixed values of the source platform's data model.

These must equal the source platform's own names, so they are stated
plainly, in natural order, as fixed values.  They are tiny and become
broadcast-sized constant DataFrames or `when` chains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------
# FIXED VALUES: object kinds (source kind name, local name of the kind).
# ---------------------------------------------------------------------------
KINDS: list[tuple[str, str]] = [
    ("Constant", "Константа"),
    ("Catalog", "Справочник"),
    ("Document", "Документ"),
    ("DocumentJournal", "ЖурналДокументов"),
    ("Enumeration", "Перечисление"),
    ("ChartOfCharacteristicTypes", "ПланВидовХарактеристик"),
    ("ChartOfAccounts", "ПланСчетов"),
    ("ChartOfCalculationTypes", "ПланВидовРасчета"),
    ("InformationRegister", "РегистрСведений"),
    ("AccumulationRegister", "РегистрНакопления"),
    ("AccountingRegister", "РегистрБухгалтерии"),
    ("CalculationRegister", "РегистрРасчета"),
    ("BusinessProcess", "БизнесПроцесс"),
    ("Task", "Задача"),
    ("ExchangePlan", "ПланОбмена"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: standard columns per kind (kind, source name, local name,
# position).  Negative positions come before the object's own attributes,
# positions near 9990 after them.
# ---------------------------------------------------------------------------
STD_COLUMNS: list[tuple[str, str, str, int]] = [
    ("Constant", "Value", "Значение", -10),
    ("Constant", "SurrogateKey", "id", 9990),
    ("Catalog", "Ref_Key", "Ссылка", -90),
    ("Catalog", "LineNumber", "НомерСтроки", -80),
    ("Catalog", "DataVersion", "ВерсияДанных", -70),
    ("Catalog", "DeletionMark", "ПометкаУдаления", -60),
    ("Catalog", "Parent_Key", "Родитель", -50),
    ("Catalog", "IsFolder", "ЭтоГруппа", -40),
    ("Catalog", "Code", "Код", -30),
    ("Catalog", "Description", "Наименование", -20),
    ("Catalog", "Predefined", "Предопределенный", 9980),
    ("Catalog", "PredefinedDataName", "ИмяПредопределенныхДанных", 9990),
    ("Document", "Ref_Key", "Ссылка", -90),
    ("Document", "LineNumber", "НомерСтроки", -80),
    ("Document", "DataVersion", "ВерсияДанных", -70),
    ("Document", "DeletionMark", "ПометкаУдаления", -60),
    ("Document", "Number", "Номер", -50),
    ("Document", "Date", "Дата", -40),
    ("Document", "Posted", "Проведен", -30),
    ("DocumentJournal", "Ref", "Ссылка", -90),
    ("DocumentJournal", "Date", "Дата", -80),
    ("DocumentJournal", "DeletionMark", "ПометкаУдаления", -70),
    ("DocumentJournal", "Number", "Номер", -60),
    ("DocumentJournal", "Posted", "Проведен", -50),
    ("DocumentJournal", "Type", "Тип", 9990),
    ("ChartOfCharacteristicTypes", "Ref_Key", "Ссылка", -90),
    ("ChartOfCharacteristicTypes", "DataVersion", "ВерсияДанных", -80),
    ("ChartOfCharacteristicTypes", "DeletionMark", "ПометкаУдаления", -70),
    ("ChartOfCharacteristicTypes", "Parent_Key", "Родитель", -60),
    ("ChartOfCharacteristicTypes", "IsFolder", "ЭтоГруппа", -50),
    ("ChartOfCharacteristicTypes", "Code", "Код", -40),
    ("ChartOfCharacteristicTypes", "Description", "Наименование", -30),
    ("ChartOfCharacteristicTypes", "ValueType", "ТипЗначения", -20),
    ("ChartOfCharacteristicTypes", "Predefined", "Предопределенный", 9980),
    ("ChartOfCharacteristicTypes", "PredefinedDataName", "ИмяПредопределенныхДанных", 9990),
    ("ChartOfAccounts", "Ref_Key", "Ссылка", -110),
    ("ChartOfAccounts", "LineNumber", "НомерСтроки", -100),
    ("ChartOfAccounts", "DataVersion", "ВерсияДанных", -90),
    ("ChartOfAccounts", "DeletionMark", "ПометкаУдаления", -80),
    ("ChartOfAccounts", "Parent_Key", "Родитель", -70),
    ("ChartOfAccounts", "Code", "Код", -60),
    ("ChartOfAccounts", "Description", "Наименование", -50),
    ("ChartOfAccounts", "Order", "Порядок", -40),
    ("ChartOfAccounts", "Type", "Вид", -30),
    ("ChartOfAccounts", "OffBalance", "Забалансовый", -20),
    ("ChartOfAccounts", "ExtDimensionTypes", "ВидыСубконто", 9970),
    ("ChartOfAccounts", "Predefined", "Предопределенный", 9980),
    ("ChartOfAccounts", "PredefinedDataName", "ИмяПредопределенныхДанных", 9990),
    ("ChartOfCalculationTypes", "Ref_Key", "Ссылка", -90),
    ("ChartOfCalculationTypes", "LineNumber", "НомерСтроки", -80),
    ("ChartOfCalculationTypes", "DataVersion", "ВерсияДанных", -70),
    ("ChartOfCalculationTypes", "DeletionMark", "ПометкаУдаления", -60),
    ("ChartOfCalculationTypes", "Code", "Код", -50),
    ("ChartOfCalculationTypes", "Description", "Наименование", -40),
    ("ChartOfCalculationTypes", "LeadingCalculationTypes", "ВедущиеВидыРасчета", -30),
    ("ChartOfCalculationTypes", "Predefined", "Предопределенный", 9980),
    ("ChartOfCalculationTypes", "PredefinedDataName", "ИмяПредопределенныхДанных", 9990),
    ("InformationRegister", "Period", "Период", -90),
    ("InformationRegister", "Recorder", "Регистратор", -80),
    ("InformationRegister", "LineNumber", "НомерСтроки", -70),
    ("InformationRegister", "Active", "Активность", -60),
    ("InformationRegister", "SurrogateKey", "id", 9990),
    ("AccumulationRegister", "Period", "Период", -90),
    ("AccumulationRegister", "Recorder", "Регистратор", -80),
    ("AccumulationRegister", "LineNumber", "НомерСтроки", -70),
    ("AccumulationRegister", "Active", "Активность", -60),
    ("AccumulationRegister", "AccountDr", "СчетДебет", -50),
    ("AccumulationRegister", "AccountCr", "СчетКредит", -40),
    ("AccountingRegister", "Period", "Период", -90),
    ("AccountingRegister", "Recorder", "Регистратор", -80),
    ("AccountingRegister", "LineNumber", "НомерСтроки", -70),
    ("AccountingRegister", "Active", "Активность", -60),
    ("AccountingRegister", "AccountDr_Key", "СчетДт", -50),
    ("AccountingRegister", "AccountCr_Key", "СчетКт", -40),
    ("CalculationRegister", "RegistrationPeriod", "ПериодРегистрации", -90),
    ("CalculationRegister", "Recorder", "Регистратор", -80),
    ("CalculationRegister", "LineNumber", "НомерСтроки", -70),
    ("CalculationRegister", "CalculationType_Key", "ВидРасчета", -60),
    ("CalculationRegister", "Active", "Активность", -50),
    ("CalculationRegister", "ReversingEntry", "Сторно", -40),
    ("BusinessProcess", "Ref_Key", "Ссылка", -90),
    ("BusinessProcess", "DataVersion", "ВерсияДанных", -80),
    ("BusinessProcess", "DeletionMark", "ПометкаУдаления", -70),
    ("BusinessProcess", "Number", "Номер", -60),
    ("BusinessProcess", "Date", "Дата", -50),
    ("BusinessProcess", "Completed", "Завершен", -40),
    ("BusinessProcess", "HeadTask", "ВедущаяЗадача", -30),
    ("BusinessProcess", "Started", "Стартован", -20),
    ("Task", "Ref_Key", "Ссылка", -90),
    ("Task", "DataVersion", "ВерсияДанных", -80),
    ("Task", "DeletionMark", "ПометкаУдаления", -70),
    ("Task", "Number", "Номер", -60),
    ("Task", "Date", "Дата", -50),
    ("Task", "Description", "Наименование", -40),
    ("Task", "Executed", "Выполнена", -30),
    ("ExchangePlan", "Ref_Key", "Ссылка", -90),
    ("ExchangePlan", "LineNumber", "НомерСтроки", -80),
    ("ExchangePlan", "DataVersion", "ВерсияДанных", -70),
    ("ExchangePlan", "DeletionMark", "ПометкаУдаления", -60),
    ("ExchangePlan", "Code", "Код", -50),
    ("ExchangePlan", "Description", "Наименование", -40),
    ("ExchangePlan", "SentNo", "НомерОтправленного", -30),
    ("ExchangePlan", "ReceivedNo", "НомерПринятого", -20),
    ("ExchangePlan", "ExchangeDate", "ДатаОбмена", -10),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: special names and literals of the source protocol.
# ---------------------------------------------------------------------------
SOURCE_PREFIX = "StandardODATA."
UNDEFINED_TYPE = "StandardODATA.Undefined"
ENUM_LOCAL_NAME = "Перечисление"
ENUM_REF_PREFIX = "EnumRef."
TYPE_DESCRIPTION = "StandardODATA.TypeDescription"
ZERO_GUID = "00000000-0000-0000-0000-000000000000"
ZERO_DATETIME = "0001-01-01T00:00:00"
NULL_TYPE_NAME = "null"
# Enumerations of the protocol itself, never mirrored.
TECHNICAL_ENUMS = ["AccountType", "AccountingRecordType", "AccumulationRecordType",
                   "AllowedSign", "AllowedLength", "DateFractions"]
REGISTER_KINDS = ["InformationRegister", "AccumulationRegister",
                  "AccountingRegister", "CalculationRegister"]
# Kinds whose paging order is the first scalar non-key columns, not the key.
SORT_BY_VALUE_KINDS = ["Constant"] + REGISTER_KINDS
SORT_TYPES = ["Edm.Guid", "Edm.Int16", "Edm.Int32", "Edm.Int64", "Edm.Double", "Edm.DateTime"]
ENUM_REF_COLUMN = "Ссылка"
ENUM_ORDER_COLUMN = "Порядок"


def kinds_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KINDS, "kind string, name string")


def std_columns_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STD_COLUMNS, "kind string, name_src string, name string, pos int")
