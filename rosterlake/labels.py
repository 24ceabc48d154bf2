"""Texts, codes and limits that reports and jobs put into their results."""

# Everything in this file has to appear in results exactly as written.

# staff reports
TOP_REASON = "Top of organizational hierarchy"
NO_DEPARTMENT_ASSIGNED = "No Department Assigned"
NO_DEPARTMENT = "No Department"
NO_MANAGER = "No Manager"
SALES = "Sales"
NO_DEPENDENT = "None"
NO_RELATIONSHIP = "N/A"
NO_EMPLOYEE = "No Employee"

# pay summaries
GRAND_TOTAL = "GRAND TOTAL"
COMPANY_LEVEL = "COMPANY WIDE"
DEPARTMENT_LEVEL = "Department"
ALL_DEPARTMENTS = "TOTAL"
ALL_GENDERS = "BOTH"

# matched and unmatched rows
NO_STAFF = "No employees"
NO_STAFF_ASSIGNED = "No employees assigned"
ORPHANED_LEAVE = "ORPHANED LEAVE"
UNASSIGNED = "UNASSIGNED"
NO_LEAVE_TYPE = "N/A"
NEVER = "Never"
NO_LEAVE = "No leaves on record"
NO_QUALIFICATION = "No certifications"
PAIR_PREFIX = "Dept-Salary Combination "

# nested reports
YES = "Yes"
NO = "No"
CONTRIBUTOR = "Individual Contributor"
APPROVER = "Approver"

# status codes and their display texts
PENDING = "PENDING"
PROCESSED = "PROCESSED"
APPROVED = "APPROVED"
REJECTED = "REJECTED"
UNKNOWN = "Unknown"
PAYMENT_TEXT = {
    "PENDING": "Awaiting Processing",
    "PROCESSED": "Ready to Pay",
    "PAID": "Paid Out",
}
LEAVE_TEXT = {
    "APPROVED": "Approved by Manager",
    "PENDING": "Awaiting Approval",
    "REJECTED": "Not Approved",
}
RENEWAL_YEARS, RENEWAL = 3, "Renewal Recommended"
CURRENT_YEARS, CURRENT = 2, "Current"
RECENT = "Recent"

# change jobs
RAISE_REASON = "Salary increase approved"
CUT_BLOCKED = "SALARY CUT BLOCKED! Current: $"
CUT_ATTEMPTED = " Attempted: $"
CUT_DECREASE = " Decrease of $"
CUT_ADVICE = ". Contact HR Department for override."
ARCHIVE_REASON = "Automatically archived on deletion"
VARIANCE_WARNING = "VARIANCE_WARNING"
VARIANCE_TEXT = "Payroll variance: "
VARIANCE_EXPECTED = "% (Expected: $"
VARIANCE_ACTUAL = ", Actual: $"
NOTICE_TEXT = "Notification: Payroll processed for "
NOTICE_NET = " - Net: $"
LEAVE_SUBMITTED = "SUCCESS: Leave request submitted ("
LEAVE_SUBMITTED_DAYS = " days)"
LEAVE_END_ERROR = "ERROR: End date must be after start date"
CUT_REFUSED = "-20100"
SALARY_MISSING = "-20030"
NAMES_REQUIRED = "-20001"
GENDER_INVALID = "-20002"
AGE_INVALID = "-20003"
STATUS_INVALID = "-20020"
DATES_INVALID = "-20200"

# percent limits of the payroll check on insert and of the daily audit
VARIANCE_LIMIT = 20
AUDIT_LIMIT = 50

# job log
SUCCESS = "SUCCESS"
FAILED = "FAILED"
WARNING = "WARNING"
SALARY_CHANGES = "Salary Changes"
PAYROLL_ISSUES = "Payroll Issues"
ARCHIVED_EMPLOYEES = "Archived Employees"

# deduction rates: bulk insert, insert from a query, processing routine
BULK_RATE = "0.20"
INSERT_RATE = "0.15"
PROCESS_RATE = "0.30"

# divisor of the period amount in the payroll view
PERIODS = 26
