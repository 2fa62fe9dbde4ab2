"""The five feed contracts and output schemas, held as data.

A contract maps each target column to the raw header names that may carry it.
``operators.project.contract_project`` resolves a contract against a frame's
header on the driver (no data is touched) and emits one ``select``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Contract aliases, final column orders, SQL types and codes.
# They must equal the source feeds' contracts for results to line up.
# ---------------------------------------------------------------------------

VOTERS_ACTIVE_CODES = ["A"]

VOTERS_CONTRACT = {
    "state_voter_id": ["VOTER_ID"],
    "name_first": ["FIRST_NAME"],
    "name_last": ["LAST_NAME"],
    "name_middle": ["MIDDLE_NAME"],
    "birthdate": ["BIRTH_DATE"],
    "party_affiliation": ["PARTY_CODE"],
    "registration_date": ["EFF_REGN_DATE"],
    "voter_status": ["STATUS"],
    "confidential": ["CONFIDENTIAL"],
    "physical_address_1": ["RES_ADDRESS_1"],
    "physical_address_2": ["RES_ADDRESS_2"],
    "physical_city": ["CITY"],
    "physical_state": ["STATE"],
    "physical_zip_code": ["ZIP_CODE"],
    "physical_house_number": ["HOUSE_NUM"],
    "physical_house_suffix": ["HOUSE_SUFFIX"],
    "physical_street_pre_direction": ["PRE_DIRECTION"],
    "physical_street_name": ["STREET_NAME"],
    "physical_street_suffix": ["STREET_TYPE"],
    "physical_street_post_direction": ["POST_DIRECTION"],
    "physical_unit_type": ["UNIT_TYPE"],
    "physical_unit_number": ["UNIT_NUM"],
    "county": ["COUNTY"],
    "precinct": ["PRECINCT"],
    "split": ["SPLIT"],
    "mail_address_1": ["EFF_ADDRESS_1"],
    "mail_address_2": ["EFF_ADDRESS_2"],
    "mail_address_3": ["EFF_ADDRESS_3"],
    "mail_address_4": ["EFF_ADDRESS_4"],
    "mail_city": ["EFF_CITY"],
    "mail_state": ["EFF_STATE"],
    "mail_zip_code": ["EFF_ZIP_CODE"],
}

VOTERS_FINAL_COLUMNS = [
    "state_voter_id", "file_date", "state", "name_first", "name_last", "name_middle",
    "birthdate", "age", "gender", "party_affiliation", "registration_date", "voter_status",
    "confidential", "physical_id", "PropertyAddressFull", "PropertyAddressHouseNumber",
    "PropertyAddressStreetDirection", "PropertyAddressStreetName", "PropertyAddressStreetSuffix",
    "PropertyAddressCity", "PropertyAddressState", "PropertyAddressZIP", "PropertyAddressZIP4",
    "PropertyAddressCRRT", "PropertyLatitude", "PropertyLongitude", "precinct_link",
    "address_type", "results", "physical_address_1", "physical_address_2", "physical_city",
    "physical_state", "physical_zip_code", "physical_house_number", "physical_house_suffix",
    "physical_street_pre_direction", "physical_street_name", "physical_street_suffix",
    "physical_street_post_direction", "physical_unit_type", "physical_unit_number", "county",
    "precinct", "split", "mail_id", "mail_address_1", "mail_address_2", "mail_address_3",
    "mail_address_4", "mail_city", "mail_state", "mail_zip_code",
]

# (type, max length) for the voters table; length None = not a string.
VOTERS_TYPES = {
    "state_voter_id": ("string", 255), "file_date": ("date", None), "state": ("string", 50),
    "name_first": ("string", 100), "name_last": ("string", 100), "name_middle": ("string", 100),
    "birthdate": ("date", None), "age": ("int", None), "gender": ("string", 7),
    "party_affiliation": ("string", 50), "registration_date": ("date", None),
    "voter_status": ("string", 50), "confidential": ("string", 50), "physical_id": ("string", 255),
    "PropertyAddressFull": ("string", 100), "PropertyAddressHouseNumber": ("string", 50),
    "PropertyAddressStreetDirection": ("string", 50), "PropertyAddressStreetName": ("string", 100),
    "PropertyAddressStreetSuffix": ("string", 50), "PropertyAddressCity": ("string", 100),
    "PropertyAddressState": ("string", 50), "PropertyAddressZIP": ("string", 20),
    "PropertyAddressZIP4": ("string", 20), "PropertyAddressCRRT": ("string", 20),
    "PropertyLatitude": ("double", None), "PropertyLongitude": ("double", None),
    "precinct_link": ("string", 255), "address_type": ("string", 50), "results": ("string", 50),
    "physical_address_1": ("string", 100), "physical_address_2": ("string", 100),
    "physical_city": ("string", 100), "physical_state": ("string", 50),
    "physical_zip_code": ("string", 20), "physical_house_number": ("string", 50),
    "physical_house_suffix": ("string", 50), "physical_street_pre_direction": ("string", 50),
    "physical_street_name": ("string", 100), "physical_street_suffix": ("string", 50),
    "physical_street_post_direction": ("string", 50), "physical_unit_type": ("string", 50),
    "physical_unit_number": ("string", 50), "county": ("string", 100), "precinct": ("string", 100),
    "split": ("string", 50), "mail_id": ("string", 255), "mail_address_1": ("string", 200),
    "mail_address_2": ("string", 200), "mail_address_3": ("string", 200),
    "mail_address_4": ("string", 200), "mail_city": ("string", 100), "mail_state": ("string", 50),
    "mail_zip_code": ("string", 20),
}

HISTORY_CONTRACT = {"state_voter_id": ["VOTER_ID"]}
HISTORY_FINAL_COLUMNS = ["state", "state_voter_id", "election_date", "voted"]
HISTORY_TYPES = {
    "state": ("string", 50), "state_voter_id": ("string", 50),
    "election_date": ("date", None), "voted": ("string", 3),
}

DAILY_CONTRACT = {
    "state_voter_id": ["VOTER_ID"],
    "voted_on_date": ["RECEIVE_DATE"],
    "county": ["county"],
}
DAILY_FINAL_COLUMNS = ["state", "county", "state_voter_id", "election_date", "voted_on_date"]
DAILY_TYPES = {
    "state": ("string", 50), "county": ("string", 50), "state_voter_id": ("string", 255),
    "election_date": ("date", None), "voted_on_date": ("date", None),
}

MOTOR_CONTRACT = {
    "state_voter_id": ["VOTER_ID", "STATE_VOTER_ID", "VTR_ID"],
    "county": ["COUNTY"],
}
MOTOR_FINAL_COLUMNS = ["state", "county", "state_voter_id", "file_date"]
MOTOR_TYPES = {
    "state": ("string", 50), "county": ("string", 50),
    "state_voter_id": ("string", 255), "file_date": ("date", None),
}

PRECINCT_CONTRACT = {
    "district_county": ["COUNTY"],
    "district_type": ["DISTRICT_TYPE"],
    "district_name": ["DISTRICT_NAME"],
    "precinct_number": ["PRECINCT_CODE", "PRECINCT"],
    "precinct_name": ["PRECINCT_NAME"],
    "precinct_split": ["SPLIT_CODE", "SPLIT"],
}
PRECINCT_FINAL_COLUMNS = [
    "file_date", "state", "district_county", "district_type", "district_name", "district_link",
    "precinct_name", "precinct_number", "precinct_split", "precinct_link",
]
PRECINCT_TYPES = {
    "file_date": ("date", None), "state": ("string", 50), "district_county": ("string", 100),
    "district_type": ("string", 100), "district_name": ("string", 100),
    "district_link": ("string", 200), "precinct_name": ("string", 100),
    "precinct_number": ("string", 100), "precinct_split": ("string", 100),
    "precinct_link": ("string", 200),
}

# Result columns set by an address lookup (hit or miss).
PLACE_RESULT_COLUMNS = [
    "results", "physical_id", "PropertyAddressFull", "PropertyAddressHouseNumber",
    "PropertyAddressStreetDirection", "PropertyAddressStreetName", "PropertyAddressStreetSuffix",
    "PropertyAddressCity", "PropertyAddressState", "PropertyAddressZIP", "PropertyAddressZIP4",
    "PropertyAddressCRRT", "PropertyLatitude", "PropertyLongitude",
]
# Place attributes searched by the token lookups (every PropertyAddress* field).
PLACE_TEXT_FIELDS = [
    "PropertyAddressFull", "PropertyAddressHouseNumber", "PropertyAddressStreetDirection",
    "PropertyAddressStreetName", "PropertyAddressStreetSuffix", "PropertyAddressCity",
    "PropertyAddressState", "PropertyAddressZIP", "PropertyAddressZIP4", "PropertyAddressCRRT",
]
# ---------------------------------------------------------------------------

_SPARK_TYPES = {
    "string": T.StringType(), "date": T.DateType(), "int": T.IntegerType(),
    "double": T.DoubleType(), "long": T.LongType(),
}


def struct_type(types: dict, columns: list[str]) -> T.StructType:
    """``StructType`` for a feed's final columns."""
    return T.StructType([T.StructField(c, _SPARK_TYPES[types[c][0]], True) for c in columns])
