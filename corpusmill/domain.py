"""Constants of the customer-support domain."""

from __future__ import annotations

# They must be as they are for right results.
INTENTS = (
    "order_status", "refund_request", "billing_inquiry", "technical_support", "complaint", "shipping_issue", "cancellation",
    "return_request", "account_management", "product_inquiry", "payment_issue", "fraud_report", "general_inquiry",
)
URGENCIES = ("critical", "high", "medium", "low")
ROLES = ("system", "user", "assistant", "tool")
#: Tool name -> parameters that a call needs.
TOOL_PARAMETERS = {
    "order_lookup_api": ("order_id",), "shipment_tracking_api": ("tracking_id",), "customer_profile_api": ("customer_id",),
    "refund_processing_api": ("order_id", "amount"), "payment_gateway_api": ("payment_id",), "invoice_verification_api": ("invoice_id",),
    "warranty_check_api": ("product_id",), "ticket_update_api": ("ticket_id", "status"), "notification_service": ("recipient", "message"),
    "policy_engine": ("policy_type", "context"), "vision_api": ("image_url",), "document_verification": ("document_url",),
}
CRITICAL_WORDS = ("fraud", "unauthorized", "stolen", "hacked", "identity theft", "locked out", "can't access", "data breach", "security")
URGENT_WORDS = (
    "urgent", "immediately", "asap", "right now", "emergency", "deadline", "can't wait", "frustrated", "unacceptable", "been waiting",
    "still waiting", "no response", "multiple times", "lawyer", "legal", "sue", "report", "bbb", "attorney general",
)
CATEGORY_INTENT = {
    "ORDER": "order_status", "REFUND": "refund_request", "INVOICE": "billing_inquiry", "FEEDBACK": "complaint", "SHIPPING": "shipping_issue",
    "DELIVERY": "shipping_issue", "CANCEL": "cancellation", "ACCOUNT": "account_management", "PAYMENT": "payment_issue",
    "CONTACT": "general_inquiry", "SUBSCRIPTION": "billing_inquiry",
}
CATEGORY_URGENCY = {
    "ORDER": "medium", "REFUND": "high", "INVOICE": "low", "FEEDBACK": "low", "SHIPPING": "medium", "DELIVERY": "medium",
    "CANCEL": "medium", "ACCOUNT": "medium", "PAYMENT": "high", "CONTACT": "low", "SUBSCRIPTION": "low",
}
QUEUE_INTENT = {
    "Technical Support": "technical_support", "IT Support": "technical_support", "Billing and Payments": "billing_inquiry",
    "Returns and Exchanges": "return_request", "Product Support": "product_inquiry", "Customer Service": "general_inquiry",
    "Service Outages and Maintenance": "complaint", "Sales and Pre-Sales": "product_inquiry", "General Inquiry": "general_inquiry",
    "Human Resources": "general_inquiry",
}
CATEGORY_TOOLS = {
    "order_status": ("order_lookup_api", "shipment_tracking_api"), "refund_request": ("order_lookup_api", "refund_processing_api"),
    "billing_inquiry": ("payment_gateway_api", "invoice_verification_api"), "complaint": ("ticket_update_api", "customer_profile_api"),
    "shipping_issue": ("shipment_tracking_api", "order_lookup_api"), "cancellation": ("order_lookup_api", "customer_profile_api"),
    "account_management": ("customer_profile_api",), "payment_issue": ("payment_gateway_api", "customer_profile_api"),
    "general_inquiry": ("ticket_update_api",),
}
CATEGORY_STEPS = {
    "order_status": ("check_order", "track_shipment", "provide_update", "notify_customer"),
    "refund_request": ("verify_order", "check_refund_eligibility", "process_refund", "send_confirmation"),
    "billing_inquiry": ("verify_identity", "check_billing_records", "resolve_discrepancy", "notify_customer"),
    "complaint": ("acknowledge_issue", "investigate_complaint", "propose_resolution", "follow_up"),
    "shipping_issue": ("check_shipment_status", "investigate_delay", "update_customer", "arrange_reshipment"),
    "cancellation": ("verify_order", "check_cancellation_policy", "process_cancellation", "confirm_refund"),
    "account_management": ("verify_identity", "update_account", "confirm_changes", "notify_customer"),
    "payment_issue": ("verify_identity", "check_payment_status", "resolve_payment", "confirm_resolution"),
    "general_inquiry": ("assess_request", "provide_information", "offer_assistance"),
}
QUEUE_TOOLS = {
    "technical_support": ("ticket_update_api", "customer_profile_api"), "billing_inquiry": ("payment_gateway_api", "invoice_verification_api"),
    "return_request": ("order_lookup_api", "refund_processing_api"), "product_inquiry": ("customer_profile_api", "policy_engine"),
    "general_inquiry": ("ticket_update_api",), "complaint": ("ticket_update_api", "customer_profile_api"),
}
QUEUE_STEPS = {
    "technical_support": ("diagnose_issue", "check_system_status", "apply_fix", "verify_resolution", "notify_customer"),
    "billing_inquiry": ("verify_identity", "check_billing_records", "resolve_discrepancy", "notify_customer"),
    "return_request": ("verify_order", "check_return_policy", "process_return", "arrange_pickup", "confirm_refund"),
    "product_inquiry": ("identify_product", "provide_information", "offer_alternatives"),
    "general_inquiry": ("assess_request", "provide_information", "offer_assistance"),
    "complaint": ("acknowledge_issue", "investigate_root_cause", "escalate_if_needed", "propose_resolution"),
}
#: Banking labels by intent; atm_support has none and falls to general_inquiry.
BANKING_LABELS = {
    "payment_issue": (
        "card_not_working", "declined_card_payment", "declined_cash_withdrawal", "declined_transfer", "failed_transfer", "pending_card_payment",
        "pending_cash_withdrawal", "pending_top_up", "pending_transfer", "contactless_not_working", "card_swallowed", "virtual_card_not_working",
        "top_up_failed",
    ),
    "billing_inquiry": (
        "card_payment_fee_charged", "cash_withdrawal_charge", "exchange_charge", "exchange_rate", "card_payment_wrong_exchange_rate",
        "extra_charge_on_statement", "top_up_by_bank_transfer_charge", "top_up_by_card_charge", "transfer_fee_charged",
        "transaction_charged_twice", "wrong_exchange_rate_for_cash_withdrawal", "direct_debit_payment_not_recognised",
        "card_payment_not_recognised", "cash_withdrawal_not_recognised", "wrong_amount_of_cash_received",
    ),
    "refund_request": ("request_refund", "refund_not_showing_up", "reverted_card_payment", "top_up_reverted"),
    "fraud_report": ("lost_or_stolen_card", "lost_or_stolen_phone", "compromised_card"),
    "account_management": (
        "activate_my_card", "change_pin", "pin_blocked", "edit_personal_details", "passcode_forgotten", "unable_to_verify_identity",
        "verify_my_identity", "verify_source_of_funds", "why_verify_identity", "card_linking", "verify_top_up",
    ),
    "cancellation": ("cancel_transfer", "terminate_account"),
    "product_inquiry": (
        "get_physical_card", "get_disposable_virtual_card", "getting_virtual_card", "getting_spare_card", "order_physical_card",
        "supported_cards_and_currencies", "fiat_currency_support", "country_support", "apple_pay_or_google_pay", "visa_or_mastercard",
        "card_acceptance", "age_limit", "exchange_via_app", "disposable_card_limits", "top_up_limits", "automatic_top_up",
        "top_up_by_cash_or_cheque", "topping_up_by_card",
    ),
    "shipping_issue": ("card_arrival", "card_delivery_estimate", "card_about_to_expire"),
    "order_status": (
        "balance_not_updated_after_bank_transfer", "balance_not_updated_after_cheque_or_cash_deposit", "transfer_not_received_by_recipient",
        "transfer_timing", "receiving_money", "transfer_into_account", "beneficiary_not_allowed",
    ),
    "general_inquiry": ("atm_support",),
}
BANKING_URGENCY = {
    "compromised_card": "critical", "lost_or_stolen_card": "critical", "lost_or_stolen_phone": "critical", "pin_blocked": "high",
    "card_not_working": "high", "declined_card_payment": "high", "failed_transfer": "high", "transaction_charged_twice": "high",
    "card_swallowed": "high", "pending_transfer": "medium",
}
#: Labels of the out-of-scope set by intent; all others are general_inquiry.
SCOPE_LABELS = {
    "order_status": ("order_status", "order", "order_checks", "flight_status", "application_status"),
    "billing_inquiry": (
        "bill_balance", "bill_due", "pay_bill", "min_payment", "transactions", "spending_history", "balance", "credit_score", "credit_limit",
        "credit_limit_change", "interest_rate", "apr", "international_fees", "exchange_rate", "redeem_rewards", "rewards_balance", "income",
        "taxes", "w2", "payday", "rollover_401k",
    ),
    "payment_issue": ("card_declined", "transfer", "direct_deposit"),
    "fraud_report": ("report_fraud", "report_lost_card", "freeze_account"),
    "account_management": (
        "account_blocked", "pin_change", "reset_settings", "change_user_name", "change_language", "change_accent", "change_ai_name",
        "change_speed", "change_volume", "sync_device", "user_name",
    ),
    "cancellation": ("cancel", "cancel_reservation"),
    "product_inquiry": ("new_card", "insurance", "insurance_change", "international_visa", "plug_type", "carry_on", "vaccines", "mpg"),
    "return_request": ("damaged_card", "lost_luggage"),
    "shipping_issue": ("replacement_card_duration",),
}
SCOPE_URGENCY = {"report_fraud": "critical", "report_lost_card": "critical", "freeze_account": "critical", "account_blocked": "high", "card_declined": "high", "oos": "low"}
COLUMN_ALIASES = {
    "customer_message": ("body", "text", "message", "input", "instruction", "query", "content"),
    "agent_response": ("response", "answer", "reply", "output", "resolution"),
    "intent": ("intent", "category", "label", "type", "class"),
    "urgency": ("urgency", "priority", "severity"),
}
PII = {
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "credit_card": r"\b(?:\d[ -]*?){13,19}\b",
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "phone": r"\b(?:\+1[ -]?)?\(?\d{3}\)?[ -]?\d{3}[ -]?\d{4}\b",
}
ADVICE_WORDS = {
    "legal": ("legal advice", "lawyer", "attorney", "sue", "lawsuit", "liable", "liability", "legally obligated", "court"),
    "medical": ("medical advice", "diagnosis", "prescribe", "medication", "doctor", "treatment plan", "medical opinion"),
    "financial": ("investment advice", "stock", "portfolio", "financial planning", "tax advice", "securities", "trading recommendation"),
}
ADVISING = ("i recommend", "you should", "i suggest", "i advise")
FRAUD_WORDS = ("fraud", "unauthorized", "stolen", "identity theft", "suspicious activity")
ESCALATION_WORDS = ("escalat", "supervisor", "specialist", "security team", "fraud team")
CLAIMS = (
    r"your order (?:is|has been|was) (?:shipped|delivered|processing)",
    r"tracking number (?:is|:)\s*\w+",
    r"refund of \$[\d.,]+ has been (?:processed|issued|approved)",
)
ACTION_WORDS = (
    "will", "going to", "have", "has been", "processed", "submitted", "initiated", "scheduled", "arranged", "confirmed", "updated",
    "resolved", "forwarded", "refund", "replacement", "credit", "track",
)
INFORMAL = r"\b(?:gonna|wanna|gotta|ya|nah|lol|omg|btw|idk|tbh|imho|bruh|dude|bro)\b"
ALLOWED_CAPS = ("API", "SLM", "JSON", "CSV", "HTML", "URL", "FAQ", "ETA", "ID", "ASAP")
ADDRESS_WORDS = ("you", "your", "you're")
EMPATHY_WORDS = ("sorry", "understand", "appreciate", "apologize", "inconvenience", "frustrat")
CONTEXT_WORDS = ("because", "reason", "due to", "this means", "next step")
SCOPE_BREACHES = {
    "legal_advice": ("legal advice", "you should sue", "liable for", "legally obligated"),
    "medical_advice": ("medical advice", "you should take", "diagnosis", "prescribe"),
    "financial_advice": ("investment advice", "you should invest", "stock recommendation"),
}
UNAUTHORIZED_REFUND = r"(?i)refund.*\$[5-9]\d{2,}|refund.*\$\d{4,}"
AUTOMATED_PHRASES = ("automatisch generierte nachricht", "auto-generated", "do not reply")
EDGE_INTENTS = ("fraud_report", "complaint", "cancellation")
CHANNELS = ("email", "chat", "phone", "social")
URGENCY_COLORS = {"critical": "#dc2626", "high": "#ea580c", "medium": "#ca8a04", "low": "#16a34a"}
#: Tool -> (parameter that comes back, what stands for a missing one, the rest of a mock answer); the refund's random id is left out.
MOCK_ANSWERS = {
    "order_lookup_api": ("order_id", "ORD-00000", {"status": "in_transit", "eta": "2026-03-20"}),
    "shipment_tracking_api": ("tracking_id", "TRK-00000", {"carrier": "FedEx", "status": "in_transit", "eta": "2026-03-19"}),
    "refund_processing_api": ("order_id", "", {"status": "processed", "estimated_days": 5}),
    "customer_profile_api": ("customer_id", "CUST-00000", {"name": "Jane Doe", "tier": "gold", "account_since": "2023-06-15"}),
}
#: The out-of-scope set's labels in order of their numbers.
SCOPE_NAMES = (
    "restaurant_reviews", "nutrition_info", "account_blocked", "oil_change_how", "time", "weather", "redeem_rewards", "interest_rate",
    "gas_type", "accept_reservations", "smart_home", "user_name", "report_lost_card", "repeat", "whisper_mode", "what_are_your_hobbies",
    "order", "jump_start", "schedule_meeting", "meeting_schedule", "freeze_account", "what_song", "meaning_of_life",
    "restaurant_reservation", "traffic", "make_call", "text", "bill_balance", "improve_credit_score", "change_language", "no",
    "measurement_conversion", "timer", "flip_coin", "do_you_have_pets", "balance", "tell_joke", "last_maintenance", "exchange_rate",
    "uber", "car_rental", "credit_limit", "oos", "shopping_list", "expiration_date", "routing", "meal_suggestion", "tire_change",
    "todo_list", "card_declined", "rewards_balance", "change_accent", "vaccines", "reminder_update", "food_last", "change_ai_name",
    "bill_due", "who_do_you_work_for", "share_location", "international_visa", "calendar", "translate", "carry_on", "book_flight",
    "insurance_change", "todo_list_update", "timezone", "cancel_reservation", "transactions", "credit_score", "report_fraud",
    "spending_history", "directions", "spelling", "insurance", "what_is_your_name", "reminder", "where_are_you_from", "distance",
    "payday", "flight_status", "find_phone", "greeting", "alarm", "order_status", "confirm_reservation", "cook_time", "damaged_card",
    "reset_settings", "pin_change", "replacement_card_duration", "new_card", "roll_dice", "income", "taxes", "date", "who_made_you",
    "pto_request", "tire_pressure", "how_old_are_you", "rollover_401k", "pto_request_status", "how_busy", "application_status", "recipe",
    "calendar_update", "play_music", "yes", "direct_deposit", "credit_limit_change", "gas", "pay_bill", "ingredients_list",
    "lost_luggage", "goodbye", "what_can_i_ask_you", "book_hotel", "are_you_a_bot", "next_song", "change_speed", "plug_type", "maybe",
    "w2", "oil_change_when", "thank_you", "shopping_list_update", "pto_balance", "order_checks", "travel_alert", "fun_fact",
    "sync_device", "schedule_maintenance", "apr", "transfer", "ingredient_substitution", "calories", "current_location",
    "international_fees", "calculator", "definition", "next_holiday", "update_playlist", "mpg", "min_payment", "change_user_name",
    "restaurant_suggestion", "travel_notification", "cancel", "pto_used", "travel_suggestion", "change_volume",
)
#: Those of them that a customer service sees.
SERVICE_LABELS = (
    "order_status", "order", "order_checks", "bill_balance", "bill_due", "pay_bill", "min_payment", "transactions", "spending_history",
    "balance", "credit_score", "credit_limit", "credit_limit_change", "interest_rate", "apr", "international_fees", "exchange_rate",
    "redeem_rewards", "rewards_balance", "income", "taxes", "w2", "payday", "rollover_401k", "card_declined", "transfer",
    "direct_deposit", "report_fraud", "report_lost_card", "freeze_account", "account_blocked", "pin_change", "reset_settings",
    "change_user_name", "cancel", "cancel_reservation", "new_card", "insurance", "insurance_change", "damaged_card",
    "replacement_card_duration", "lost_luggage", "oos",
)
#: Sentences of the converted answers; {0} is the label in words or what the name says.
CATEGORY_REASONING = ("Customer request categorized as ", " (", "). Urgency: ", ".")
QUEUE_REASONING = ("Ticket routed to ", " queue with ", " priority. Type: ", ". Classified as ", ".")
LABEL_REASONING = ("Customer is asking about ", ". Classified as ", " with ", " urgency.")
ANNOTATED_REASONING = ("Customer intent is ", " with ", " urgency. Required workflow: ", ".")
BANKING_RESPONSE = ("I understand you're experiencing an issue with ", ". Let me look into this for you right away and get it resolved as quickly as possible.")
SCOPE_RESPONSE = ("I'd be happy to help you with ", ". Let me pull up the relevant information and get this sorted out for you right away.")
OUT_OF_SCOPE_REASONING = "Request is outside standard service categories. Escalating to a human agent."
OUT_OF_SCOPE_RESPONSE = "I appreciate you reaching out. This falls outside my area of expertise, so let me connect you with a specialist who can assist you properly."
NO_TOOL_CALL = "No tool call needed."
TOOL_SCHEMAS_HEAD = "\n\nAvailable function schemas:\n"
#: Training mix -> source -> weight.
DATA_MIXES = {
    "intent_classifier": {"bitext/Bitext-customer-support-llm-chatbot-training-dataset": 0.3, "PolyAI/banking77": 0.3, "clinc/clinc_oos": 0.2, "annotated": 0.2},
    "response_generator": {
        "annotated": 0.30, "bitext/Bitext-customer-support-llm-chatbot-training-dataset": 0.25, "bitext/Bitext-retail-ecommerce-llm-chatbot-training-dataset": 0.15,
        "gretelai/gretel-safety-alignment-en-v1": 0.15, "arcee-ai/agent-data": 0.15,
    },
    "tool_caller": {"arcee-ai/agent-data": 0.4, "Salesforce/xlam-function-calling-60k": 0.3, "NousResearch/hermes-function-calling-v1": 0.15, "Team-ACE/ToolACE": 0.15},
    "workflow_reasoner": {"annotated": 0.4, "bitext/Bitext-customer-support-llm-chatbot-training-dataset": 0.3, "arcee-ai/agent-data": 0.3},
    "dpo": {"argilla/ultrafeedback-binarized-preferences-cleaned": 0.6, "nvidia/HelpSteer3": 0.3, "preferences": 0.1},
    "simpo": {"argilla/ultrafeedback-binarized-preferences-cleaned": 0.5, "nvidia/HelpSteer3": 0.3, "preferences": 0.2},
    "chat": {
        "bitext_cs": 0.20, "bitext_ecom": 0.20, "customer_support_tickets": 0.15, "bitext_banking": 0.05, "bitext_insurance": 0.05, "banking77": 0.05, "clinc_oos": 0.02,
        "arcee_agent": 0.15, "xlam_60k": 0.08, "hermes_fc": 0.05,
    },
}
# End of the fixed values.

SYSTEM_TEMPLATE = "You are a customer service agent for {company}. Available tools: {tools}. Answer in JSON with: intent, urgency, workflow_steps, tools_required, reasoning, response."


def system_prompt(company: str = "our company", tools: tuple[str, ...] = tuple(TOOL_PARAMETERS)) -> str:
    return SYSTEM_TEMPLATE.format(company=company, tools=", ".join(tools))


SYSTEM_PROMPT = system_prompt()
#: Label -> intent, from the tables above.
BANKING_INTENT = {x: intent for intent, labels in BANKING_LABELS.items() for x in labels}
SCOPE_INTENT = {x: intent for intent, labels in SCOPE_LABELS.items() for x in labels}
