"""Recommendation texts, display metadata and report wording."""

# --- fixed values: recommendations per category and risk level ----------------
INDUSTRIAL_CONTROLS = {
    "Safe": [
        "Maintain existing emission control systems and scheduled maintenance.",
        "Continue regular stack emission monitoring as per compliance requirements.",
        "Encourage use of cleaner fuels in production processes.",
    ],
    "Caution": [
        "Review and tighten emission permits for major industrial facilities.",
        "Implement continuous emission monitoring systems (CEMS) at all stacks.",
        "Promote adoption of Best Available Techniques (BAT) for emission reduction.",
        "Establish industry-wide voluntary emission reduction targets.",
    ],
    "Alert": [
        "Mandate immediate emission audits for top 10 industrial polluters.",
        "Enforce stricter industrial discharge limits under Clean Air Act provisions.",
        "Install advanced scrubbers and filtration systems at major facilities.",
        "Reduce production output by 20-30% during high pollution episodes.",
        "Issue industrial zone pollution warnings to nearby communities.",
    ],
    "Critical": [
        "🚨 EMERGENCY: Suspend operations at highest-emitting facilities immediately.",
        "Activate emergency industrial pollution response protocol.",
        "Require real-time reporting from all industrial emitters.",
        "Enforce mandatory pollution controls before resuming full operations.",
        "Consider temporary industrial output restrictions.",
    ],
}

TRAFFIC_MANAGEMENT = {
    "Safe": [
        "Promote carpooling and public transit usage among residents.",
        "Encourage shift to electric or hybrid vehicles through incentives.",
    ],
    "Caution": [
        "Implement congestion pricing during peak traffic hours.",
        "Expand bicycle lanes and pedestrian pathways.",
        "Introduce emission testing requirements for older vehicles.",
        "Promote flexible work-from-home arrangements to reduce commute traffic.",
    ],
    "Alert": [
        "Restrict high-emission diesel vehicles in urban centres.",
        "Create low-emission zones with mandatory compliance.",
        "Increase frequency of public transit to reduce private vehicle use.",
        "Suspend non-essential construction vehicle operations during peak pollution.",
    ],
    "Critical": [
        "🚨 Enforce emergency vehicle traffic restrictions.",
        "Ban all non-essential vehicle traffic in the most polluted zones.",
        "Deploy additional rapid transit capacity immediately.",
        "Coordinate with police for active traffic pollution enforcement.",
    ],
}

MONITORING = {
    "Safe": [
        "Maintain current air quality monitoring station network.",
        "Continue hourly data reporting to public air quality index platforms.",
    ],
    "Caution": [
        "Deploy additional low-cost sensor nodes in residential neighborhoods.",
        "Increase monitoring frequency to 30-minute intervals.",
        "Establish real-time public dashboard for air quality data.",
        "Conduct community air quality awareness workshops.",
    ],
    "Alert": [
        "Activate full monitoring network at all stations simultaneously.",
        "Deploy mobile air quality labs to high-risk areas.",
        "Establish hourly briefings for local government emergency teams.",
        "Issue air quality alerts via SMS and emergency broadcast systems.",
    ],
    "Critical": [
        "🚨 Activate emergency air quality monitoring protocol.",
        "Deploy all available monitoring assets for 24/7 coverage.",
        "Coordinate with national/regional environmental agencies.",
        "Establish incident command center for pollution emergency response.",
    ],
}

GREEN_INFRASTRUCTURE = {
    "Safe": [
        "Plant 1,000+ trees annually as part of urban greening initiatives.",
        "Develop rooftop gardens and green corridors.",
        "Create community parks with native vegetation.",
    ],
    "Caution": [
        "Fast-track urban forestry programs targeting pollution hotspots.",
        "Install green barriers (hedges, trees) along major roadways.",
        "Develop wetlands and natural filtration zones.",
        "Implement green building codes requiring rooftop vegetation.",
    ],
    "Alert": [
        "Emergency tree planting campaign in highest-pollution zones.",
        "Install biofiltration walls in residential areas near industrial zones.",
        "Create green buffer zones between industrial and residential areas.",
        "Fund rapid deployment of urban air purification installations.",
    ],
    "Critical": [
        "🚨 Immediate installation of HEPA air filtration units in public spaces.",
        "Deploy portable air purifiers in schools and hospitals.",
        "Accelerate industrial buffer zone creation with tall vegetation.",
        "Commission large-scale moss/green wall installations on key buildings.",
    ],
}

PUBLIC_HEALTH = {
    "Safe": [
        "Maintain public awareness of current air quality index readings.",
        "Encourage outdoor physical activity during low-pollution hours.",
    ],
    "Caution": [
        "Advise sensitive groups (children, elderly, asthmatics) to limit prolonged outdoor exposure.",
        "Distribute N95/FFP2 masks to healthcare facilities and schools.",
        "Update school outdoor activity policies based on AQI thresholds.",
        "Issue advisory to residents to keep windows closed during peak pollution hours.",
    ],
    "Alert": [
        "Issue public health advisory: limit outdoor activity for all residents.",
        "Provide free N95 masks at community centres, schools, and transit hubs.",
        "Activate respiratory clinic capacity surge protocols.",
        "Advise vulnerable populations to shelter in place.",
        "Alert hospitals to prepare for increased respiratory and cardiovascular admissions.",
    ],
    "Critical": [
        "🚨 HEALTH EMERGENCY: Order residents to stay indoors with sealed ventilation.",
        "Activate emergency health response teams and field medical units.",
        "Open emergency clean-air shelters for vulnerable populations.",
        "Issue mandatory outdoor mask orders for the affected areas.",
        "Coordinate with hospitals to defer elective procedures and prepare ICU capacity.",
    ],
}

POLICY = {
    "Safe": [
        "Continue enforcing existing environmental regulations.",
        "Invest in long-term renewable energy transition programs.",
    ],
    "Caution": [
        "Review and update emission standards to align with WHO 2021 guidelines.",
        "Introduce carbon pricing mechanisms for major industrial emitters.",
        "Fund research into cleaner production technologies.",
    ],
    "Alert": [
        "Fast-track legislative changes to strengthen air quality standards.",
        "Declare pollution hotspots as environmental priority zones.",
        "Increase environmental enforcement staffing by 50%.",
        "Mandate environmental impact assessments for all new industrial projects.",
    ],
    "Critical": [
        "🚨 Declare environmental emergency in affected area.",
        "Invoke emergency executive powers for immediate pollution control.",
        "Suspend all new industrial permit approvals pending pollution review.",
        "Coordinate national and international emergency environmental response.",
    ],
}

URGENT_ACTIONS = {
    "Alert": [
        "⚠️ Issue public air quality alert across all channels.",
        "Activate emergency pollution reduction protocol.",
        "Coordinate immediate response with environmental agencies.",
    ],
    "Critical": [
        "🚨 DECLARE ENVIRONMENTAL EMERGENCY immediately.",
        "Evacuate sensitive populations from highest-risk zones.",
        "Activate multi-agency emergency response coordination.",
    ],
}

# --- fixed values: category -> (audience, texts, display title, display icon, report title, report icon)
CATEGORIES = {
    "monitoring": ("all", MONITORING, "📡 Air Quality Monitoring", "📊", "Monitoring", "📡"),
    "green_infrastructure": ("all", GREEN_INFRASTRUCTURE, "🌳 Green Infrastructure", "🌱", "Green Infrastructure", "🌳"),
    "public_health": ("all", PUBLIC_HEALTH, "🫁 Public Health Precautions", "💊", "Public Health", "🫁"),
    "policy": ("all", POLICY, "📋 Policy Recommendations", "⚖️", "Policy", "📋"),
    "industrial_controls": (
        "industrial", INDUSTRIAL_CONTROLS, "🏭 Industrial Emission Controls", "🔧", "Industrial Controls", "🏭",
    ),
    "traffic_management": ("other", TRAFFIC_MANAGEMENT, "🚗 Traffic Management", "🛣️", "Traffic Management", "🚗"),
    "urgent_actions": ("all", URGENT_ACTIONS, "⚡ Urgent Actions Required", "🚨", "Urgent Actions", "🚨"),
}
DEFAULT_ICON = "📌"

# --- fixed values: level -> (colour, badge, timeframe, icon)
PRIORITIES = {
    "Safe": ("#22c55e", "🟢 Low Priority", "Long-term (6-12 months)", "✅"),
    "Caution": ("#eab308", "🟡 Medium Priority", "Short-term (1-3 months)", "⚠️"),
    "Alert": ("#f97316", "🟠 High Priority", "Immediate (1-2 weeks)", "🔔"),
    "Critical": ("#ef4444", "🔴 CRITICAL — Act Now", "EMERGENCY (24-48 hours)", "🚨"),
}
DEFAULT_LEVEL = "Caution"

# --- fixed values: report wording, {names} are filled per row -----------------
HEADER = "# 🌍 Environmental Impact Assessment Report\n*Generated: {now}*\n"

EXECUTIVE_SUMMARY = (
    "## Executive Summary\n\n"
    "This assessment evaluates environmental conditions for a **{city}** area "
    "(model confidence: {city_conf}%) with a composite Environmental Risk Score of "
    "**{score}/100 ({level} level)**. "
    "Current pollution levels are classified as **{severity}** "
    "with a **{trend}** trend. "
    "Health impact is predicted as **{health}** "
    "(confidence: {health_conf}%). "
    "{advice}\n"
)
SUMMARY_URGENT = "Immediate action is recommended."
SUMMARY_CALM = "Continue monitoring and preventive measures."

AIR_QUALITY = (
    "## Air Quality Assessment\n\n"
    "| Metric | Value |\n"
    "|--------|-------|\n"
    "| Current Pollution Level | {pollution} |\n"
    "| Pollution Severity | {severity} |\n"
    "| Pollution Trend | {trend} |\n"
    "| Predicted Next Period | {predicted} |\n\n"
    "Pollution levels have been assessed against WHO and EPA reference thresholds. "
    "{advice}\n"
)
AIR_HIGH = "Current levels exceed safe thresholds — protective action is warranted."
AIR_CALM = "Current levels are within manageable ranges."

CITY_CLASSIFICATION = (
    "## Area Classification\n\n"
    "The ML model classifies this area as **{city}** with "
    "**{city_conf}% confidence** based on analysis of six key air pollutants "
    "(CO, NO₂, SO₂, O₃, PM₂.₅, PM₁₀). "
    "{advice}\n"
)
CITY_INDUSTRIAL = "Industrial classification indicates elevated emission sources requiring enhanced monitoring."
CITY_OTHER = "Residential classification suggests lower baseline industrial emissions."

DISCLAIMER = (
    "\n> ⚠️ **IMPORTANT HEALTH & MEDICAL DISCLAIMER**\n"
    "> \n"
    "> Health Impact predictions are **analytical estimates** based on air quality data ONLY.\n"
    "> They are **NOT** medical diagnoses, professional medical advice, or a substitute for\n"
    "> consultation with qualified healthcare professionals. Do not use this report for\n"
    "> medical decision-making. Always consult a licensed physician for health concerns.\n"
)
HEALTH_IMPACT = (
    "## Health Impact Assessment\n\n"
    + DISCLAIMER
    + "\n\nPredicted health impact category: **{health}** (confidence: {health_conf}%)\n\n"
    "{advice}\n"
)
HEALTH_HIGH = (
    "⚠️ High-risk health impact detected. Vulnerable populations (children, elderly, people with "
    "respiratory conditions) should take immediate protective measures."
)
HEALTH_CALM = "Health impacts remain at moderate or lower levels. Standard precautions are advised."

RISK_TABLE = (
    "## Environmental Risk Level\n\n"
    "**Overall Risk Score: {score} / 100 — {level}**\n\n"
    "| Component | Factor Value | Weight | Contribution |\n"
    "|-----------|-------------|--------|--------------|\n"
    "| Pollution Factor | {pollution_factor} | 40% | {pollution_part} |\n"
    "| Health Impact Factor | {health_impact_factor} | 30% | {health_impact_part} |\n"
    "| Industrial Factor | {industrial_factor} | 20% | {industrial_part} |\n"
    "| Trend Factor | {trend_factor} | 10% | {trend_part} |\n"
    "| **TOTAL** | | **100%** | **{score}** |\n"
)

RECOMMENDATIONS_TITLE = "## Mitigation Recommendations\n"
RECOMMENDATIONS_NONE = "## Mitigation Recommendations\n\n*No recommendations available.*\n"

CONCLUSION = (
    "## Conclusion & Next Steps\n\n"
    "Based on the comprehensive analysis, this {city} area presents a "
    "**{level}** environmental risk with a score of {score}/100. "
    "{advice}\n\n"
    "*This report was generated by the Automated Environmental Impact Assessment System. "
    "All predictions are model-based estimates and should be validated against ground-truth measurements.*\n"
)
CONCLUSION_ADVICE = {
    "Critical": (
        "URGENT: Implement the critical actions listed above within 24-48 hours. "
        "Coordinate with environmental and health authorities immediately."
    ),
    "Alert": (
        "ALERT: Begin implementing recommended mitigation strategies within 1-2 weeks. Increase monitoring frequency."
    ),
    "Safe": "Continue regular monitoring and implement preventive measures to avoid deterioration.",
    "Caution": "Continue regular monitoring and implement preventive measures to avoid deterioration.",
}
SECTION_ORDER = [
    "header", "executive_summary", "air_quality", "city_classification", "health_impact", "risk_score",
    "recommendations", "conclusion",
]
SECTION_SEPARATOR = "\n\n---\n\n"

# --- fixed values: question prompts -------------------------------------------
SYSTEM_PROMPT = (
    "You are an Environmental AI Consultant. "
    "Answer ONLY using the retrieved documents below. "
    "If the answer is not in the documents, say: "
    "'The knowledge base does not contain enough information.' "
    "Cite source filenames in [brackets]. "
    "Keep answers under 200 words."
)
NO_DOCUMENTS = "No relevant documents found."
QUESTION_TASK = (
    "\n\nProvide: 1) Direct answer 2) Brief explanation 3) Mitigation (if relevant) "
    "4) References [filename]. Under 200 words."
)
# field -> label, in output order
PREDICTION_LINE = {
    "city_type": "Area", "health_impact": "Health", "pollution_level": "Pollution", "risk_level": "Risk",
    "aqi": "AQI", "trend": "Trend",
}
ENRICHMENT_FIELDS = {
    "city_type": "Area type", "health_impact": "Health impact", "pollution_level": "Pollution level",
    "risk_level": "Risk level", "aqi": "AQI", "trend": "Pollution trend", "model_name": "Prediction model",
    "confidence": "Confidence",
}
