"""The sentences of access requests, for tables and streams alike."""

# --- fixed values: agents and reviewers' tools match these sentences, so they must stay as they are.
# Each is the text between the values that it names, in order.
REFUSED = ("Maximum pending requests reached (", "). Resolve existing requests before submitting new ones.")
CREATED = (
    "Access request ",
    " created for ",
    ' entity "',
    '". A user must review and approve this request before the original text is revealed.',
)
BAD_ACTION = ('Invalid action "', '". Must be one of: ')
BAD_STATUS = ('Invalid status filter "', '". Must be one of: ')
NO_ID = "Either request_id or request_ids must be provided."
NOT_FOUND = ('Request "', '" not found.')
SETTLED = ('Request "', '" is already ', ". Cannot resolve again.")
APPROVED = "Access approved. Original text: "
APPROVED_BLANK = "Access approved, but original text was not captured during redaction."
DENIED = "Access denied."
ASKED = ('Follow-up question sent to agent: "', '"')
# ---
