"""Record layouts shared by every job, as DDL text that every Spark reader accepts."""

from __future__ import annotations

# The envelope and payload field names and types producers send.
ENVELOPE_DDL = """
    _event_timestamp string, _event_id string, _category string, _event_type string,
    _version string
"""
PAYLOAD_DDL = """
    authCode string, subRequestId double, aua string, sa string, asa string, ver string,
    tid string, licenseId string, reqDateTime string, tknUsedFlag double, tknType string,
    pidTs string, pidVersion string, piUsesFlag double, paUsesFlag double, pfaUsesFlag double,
    bioUsesFlag double, btFMRUsesFlag double, btFIRUsesFlag double, btIIRUsesFlag double,
    pinUsesFlag double, otpUsesFlag double, piUsedFlag double, paUsedFlag double,
    pfaUsedFlag double, bioUsedFlag double, btFMRUsedFlag double, btFIRUsedFlag double,
    btIIRUsedFlag double, pinUsedFlag double, otpUsedFlag double, otpIdentifier string,
    lang string, piNameUsedFlag double, piMs string, piMv string, piMatchScore double,
    piLNameUsedFlag double, piLNameMs string, piLNameMv string, piLNameMatchScore double,
    piPhoneUsedFlag double, piEmailUsedFlag double, piGenderUsedFlag double, piGender string,
    piDOBUsedFlag double, piDOB string, pi_DOBTUsedFlag double, piDOBT string,
    piAgeUsed_flag double, piAge string, pfaAddressUsedFlag double, pfaAddressMs string,
    pfaAddressMv string, pfaMatchScore double, pfaLaddrUsedFlag double,
    pfaLocalAddressMs string, pfaLocalAddressMv string, pfaLocalAddressMatcScore double,
    paMs string, paCareOfUsedFlag double, paHouseUsedFlag double, paStreetUsedFlag double,
    paLmUsedFlag double, paLOCUsedFlag double, paVTCUsedFlag double, paVTC string,
    paPOUsedFlag double, paPO string, paSubDistrictUsedFlag double, paSubDistrict string,
    paDistrictUsedFlag double, paDistrict string, paStateUsedFlag double, paState string,
    paPCUsedFlag double, paPC string, fmrCount double, firCount double, iirCount double,
    fingerMatchScore double, uidaiTFMR double, auaTFMR double, fingerMatchThreshold double,
    fmrGalleryType string, fmrGalleryVendor string, fmrSDKVendor string, fmrSDKVersion string,
    firGalleryType string, firGalleryVendor string, firSDKVendor string, firSDKVersion string,
    iirGalleryType string, iirGalleryVendor string, iirSDKVendor string, iirSDKVersion string,
    authResult string, errorCode string, errorClassification string, responseDateTime string,
    authDuration double, fdc string, idc string, udc string, locationLat string,
    locationLong string, locationVTCCode string, locationSubDistrictCode string,
    locationDistrictCode string, locationStateCode string, locationPC string,
    enrolmentReferenceId string, residentGender string, residentBirth_Day double,
    residentBirthMonth double, residentBirthYear double, residentDOB string,
    residentDOBT string, residentAge double, residentPincode string, residentVTCCode string,
    residentVTCName string, residentPOName string, residentSubDistrictCode string,
    residentSubDistrictName string, residentDistrictCode string, residentDistrictName string,
    residentStateCode string, residentStateName string, uidGenerationDate string, txn string,
    authType string, hashUID string, locationAlt string, lot string, bfdDoneFlag double,
    fingerMatchingType string, fingerFusionPerfomed double, irisMatchScore double,
    irisThreshold double, irisMatchingType string, irisFusionPerfomed double,
    authXMLSize double, pidSize double, dataType string, skeyScheme string, sskType string,
    ki string, kycFlag double, actionCodes string, registeredDeviceSoftwareId string,
    registeredDeviceSoftwareVersion string, deviceProviderId string, deviceCode string,
    modelId string, certExpiryDate string, subErrorCode string, authenticationMode string,
    faceUses double, faceUsed double, faceMatchScore double, faceMatchThreshold double,
    faceMatchType string, faceFusionDone double, faceMultimodalityFusionScore double,
    faceMultimodalityFusionThreshold double, faceSdkVendor string, faceSdkVersion string,
    deviceMetaData string, deepPrintGalleryType string, deepPrintGalleryVendor string,
    deepPrintSdkVendor string, deepPrintSdkVersion string, deepPrintMatchScoreFinger1 double,
    deepPrintMatchScoreFinger2 double, deepPrintMatchIsPerfomed double,
    deepPrintMatchResult double, serverId string
"""

def fields(ddl: str) -> dict[str, str]:
    """Name to type, in order, of a flat DDL text."""
    return dict(part.split() for part in ddl.split(",") if part.strip())


ENVELOPE_FIELDS = list(fields(ENVELOPE_DDL))
PAYLOAD_TEXT_FIELDS = [n for n, t in fields(PAYLOAD_DDL).items() if t == "string"]
PAYLOAD_NUMBER_FIELDS = [n for n, t in fields(PAYLOAD_DDL).items() if t == "double"]

EVENTS = (
    "event_id string, reference_id string, timestamp long, category string, "
    "event_type string, payload string"
)

SEGMENTS = (
    "bucket string, key string, timestamp long, writer string, segment string, size long"
)
CURSORS = "bucket string, last_key string"
