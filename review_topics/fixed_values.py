"""Values that fix the meaning of the results: prompts, schemas, topic lists and defaults.

All of this file is FIXED VALUES: texts and constants that must stay exactly as they are for a model to
receive the same question and for a topic to carry the same name.
"""

# --- fixed values: extraction request -------------------------------------------------------------------------
SYSTEM_MESSAGE = (
    "You are a helpful analyst for a major airline. "
    "You help anayze customer reviews and extrarct insights."
)
MAX_TOKENS = 500
TEMPERATURE = 0.1
MAX_ATTEMPTS = 3
MAX_IN_FLIGHT = 5
BACKOFF_SECONDS = (1.0, 30.0)

EXTRACTION_PROMPT = """
Follow instructions below and extract intents from a customer review as a json string. DO NOT include any notes or additional information in the output.

### Instructions:
- **Identify each distinct intent** in the review as "intent". The review may contain multiple distinct intents related to different aspects of the customer's experience (e.g., service, seating, food, check-in, baggage handling). 
- **Summarize the text** associated with each intent as "text_summary".
- **Classify the sentiment** (Positive, Negative, or Neutral) of each intent as "sentiment".
- **If applicable, extract any "named entities"**, such as the airline name or specific service mentioned.
- **Return a list of intents a JSON string.** Follow the output format and use example ouput below as a reference. Make sure the JSON string is COMPLETE. Do not include additional information.

### Output Format
{format_instructions}

### Example Review:
"I flew with XYZ Airlines for a 6-hour flight. The check-in process was smooth, but the seating was cramped, and the food quality was below average. The flight attendants were very polite and helpful. I had an issue with my baggage, but it was quickly resolved."

### Example Output (JSON format):
{example_output}

### Review to analyze:
{review}

"""

EXAMPLE_REVIEW = (
    "I flew with XYZ Airlines for a 6-hour flight. The check-in process was smooth, but the seating was cramped, "
    "and the food quality was below average. The flight attendants were very polite and helpful. I had an issue "
    "with my baggage, but it was quickly resolved."
)

FORMAT_INSTRUCTIONS = {
    "intents": [
        {
            "intent": "<Intent description>",
            "text_summary": "<Summarized or specific text related to the intent>",
            "sentiment": "<Positive | Negative | Neutral>",
            "named_entities": ["<Named entities, if any>"],
        },
        {
            "intent": "<Intent description>",
            "text_summary": "<Summarized or specific text related to the intent>",
            "sentiment": "<Positive | Negative | Neutral>",
            "named_entities": ["<Named entities, if any>"],
        },
    ]
}

EXAMPLE_OUTPUT = {
    "intents": [
        {
            "intent": "Check-in experience",
            "text_summary": "The check-in process was smooth.",
            "sentiment": "Positive",
            "named_entities": ["XYZ Airlines"],
        },
        {
            "intent": "Seating comfort",
            "text_summary": "The seating was cramped.",
            "sentiment": "Negative",
            "named_entities": [],
        },
        {
            "intent": "Food quality",
            "text_summary": "The food quality was below average.",
            "sentiment": "Negative",
            "named_entities": [],
        },
        {
            "intent": "Flight attendant service",
            "text_summary": "The flight attendants were very polite and helpful.",
            "sentiment": "Positive",
            "named_entities": [],
        },
        {
            "intent": "Baggage issue",
            "text_summary": "I had an issue with my baggage, but it was quickly resolved.",
            "sentiment": "Neutral",
            "named_entities": [],
        },
    ]
}

SENTIMENTS = ["Positive", "Negative", "Neutral"]

TOOLS = [
    {
        "type": "function",
        "function": {
            "name": "extracts_intents",
            "parameters": {
                "type": "object",
                "properties": {
                    "intents": {
                        "type": "array",
                        "description": "List of intents identified from the customer review",
                        "items": {
                            "type": "object",
                            "properties": {
                                "intent": {"type": "string", "description": "Description of the identified intent"},
                                "text_summary": {"type": "string", "description": "Summary of the intent"},
                                "sentiment": {
                                    "type": "string",
                                    "enum": ["Positive", "Negative", "Neutral"],
                                    "description": "Sentiment of the intent",
                                },
                                "named_entities": {
                                    "type": "array",
                                    "items": {
                                        "type": "string",
                                        "description": "Named entities in the text, if any, "
                                        "like 'Chicago' or 'XYZ Airlines'",
                                    },
                                },
                            },
                            "required": ["intent", "text_summary", "sentiment"],
                        },
                    }
                },
            },
        },
    }
]

# --- fixed values: topics --------------------------------------------------------------------------------------
PREDEFINED_TOPICS = [
    "Check-in and Boarding",
    "Seating Comfort",
    "In-Flight Wi-Fi",
    "Cabin Cleanliness",
    "Food and Beverage",
    "Flight Attendants and Crew Services",
    "Baggage Handling",
    "Flight Disruptions and Delays",
    "Loyalty Program and benefits",
    "Pricing Transparency and Fees",
    "Safety Measures",
    "Ground Services Assistance",
    "Accessibility and special assistance",
]
MIN_SIMILARITY = 0.6
MIN_TOPIC_SIZE = 50
OUTLIER_LABEL = "Outlier Topic"
MMR_DIVERSITY = 0.3
LABEL_DOCUMENTS = 5
CHARTED_TOPICS = 10

LABEL_PROMPT = """
Generate a short topic label based on reviews and key words describing the reviews. 

Make sure the response only contains the topic label. The response should be in the following format:
'''
topic: <topic label>
'''

Here are some examples of topic labels: 
'''
topic: Seating Comfort
topic: Food and Beverage Quality
topic: Baggage Handling
'''

Here are the reviews:
[DOCUMENTS]

Here are the keywords that are relevant to the reviews. Use them as reference for the topic label, but keep in mind the key words are not always the most representative. [KEYWORDS]

Now read the reviews and keywords carefully, and respond with the topic label that best categories the reviews. Remember to respond in the correct format.
"""

# --- fixed values: sentences used to try out a fitted model ------------------------------------------------------
PROBE_IN_DOMAIN = "Cabin crew service: Felt like a nuisance and was deliberately ignored by male cabin crew."
PROBE_OUT_OF_DOMAIN = (
    "the movie was great but was having some audio glitches along the way which put off the experience"
)
