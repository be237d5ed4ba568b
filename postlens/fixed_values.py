"""Results are only right with exactly these lists, tables and numbers.

Everything here is a default. Each operator takes its values as arguments, so another market
(other titles, skills, currencies) needs no change to the library.
"""

# --- Fixed values: salary bands (lower bound included, upper bound excluded) ---
BAND_CUTS = (60000, 90000, 120000, 150000, 180000)
BAND_LABELS = (
    "Under $60k",
    "$60k - $90k",
    "$90k - $120k",
    "$120k - $150k",
    "$150k - $180k",
    "Over $180k",
)

# --- Fixed values: labels ---
REMOTE = "Remote"
DEMAND_LABELS = ("Low", "Medium", "High")
CATEGORICAL = ("job_title", "experience_level", "job_type", "industry")
EXTRACT_COLUMNS = (
    "job_title",
    "location",
    "experience_level",
    "job_type",
    "salary",
    "skills",
    "industry",
    "demand_score",
)

# --- Fixed values: limits of the served results ---
TOP_SKILLS = 15
SEARCH_LIMIT = 40
ROADMAP_STEPS = 5
ROADMAP_HIGH_ABOVE = 115000
ROADMAP_REASON = "Expands market capability, average salary is {}."
WHAT_IF_CANDIDATES = 15
WHAT_IF_MIN_GAIN = 500
WHAT_IF_BEST = 3
TOP_DRIVERS = 4

# --- Fixed values: training ---
FOREST_TREES = 50
FOREST_DEPTH = 15
FOREST_SEED = 42
TEST_PERCENT = 20

# --- Fixed values: demand points ---
HOT_SKILLS = ("Python", "PySpark", "Kubernetes", "React")
BUSY_LEVELS = ("Entry-level", "Mid-level")
BUSY_INDUSTRIES = ("Tech", "Finance")
REMOTE_POINTS, HOT_SKILL_POINTS, LEVEL_POINTS, INDUSTRY_POINTS = 2, 2, 1, 1
HIGH_FROM, MEDIUM_FROM = 5, 3

# --- Fixed values: expected pay ---
BASE_PAY = {
    "Software Engineer": 95000,
    "Data Scientist": 105000,
    "Frontend Developer": 85000,
    "Backend Developer": 90000,
    "Fullstack Developer": 95000,
    "DevOps Engineer": 105000,
    "Data Engineer": 100000,
    "Product Manager": 110000,
    "Cyber Security Analyst": 95000,
    "Cloud Architect": 125000,
}
LEVEL_PERCENT = {"Entry-level": 70, "Mid-level": 100, "Senior": 140, "Lead": 170}
JOB_TYPE_STEP = {"Remote": 5000, "Onsite": -3000}
SKILL_TIERS = (
    (8000, ("PySpark", "Kubernetes", "TensorFlow", "Terraform", "Cloud Architect", "AWS", "Go")),
    (4000, ("Python", "React", "TypeScript", "Docker", "CI/CD")),
)
PAY_FLOOR = 30000

# --- Fixed values: role frameworks, role -> milestones (title, description, base skills) ---
DEFAULT_ROLE = "Data Scientist"
ROLE_FRAMEWORKS = {
    "Data Scientist": [
        ("Core Foundations", "Master mathematical foundations, statistics, Python programming, and data querying.", ["Python", "SQL"]),
        ("Big Data Engineering", "Leverage Spark and Hadoop for distributed datasets and cleaning at scale.", ["PySpark", "Hadoop"]),
        ("Machine Learning", "Implement Random Forest, deep models, and serialize artifacts for serving.", ["Machine Learning", "Scikit-Learn"]),
    ],
    "Machine Learning Engineer": [
        ("Algorithms & Data", "Build high-performance feature pipelines and custom statistical models.", ["Python", "Machine Learning"]),
        ("Big Data & Ingestion", "Process stream and batch jobs using Apache Spark.", ["PySpark", "Kubernetes"]),
        ("Model Deployment", "Package inference APIs in FastAPI and containerize services.", ["Docker", "AWS", "FastAPI"]),
    ],
    "Data Analyst": [
        ("Data Querying", "Write advanced relational database queries and structure raw schemas.", ["SQL"]),
        ("Analysis & Viz", "Create dashboard reports and perform exploratory statistical sweeps.", ["Python", "PowerBI"]),
        ("Version Control", "Manage files and collaborative pipelines cleanly.", ["Git"]),
    ],
    "DevOps Engineer": [
        ("Automation & Versioning", "Master Git workflows, bash scripting, and deployment pipelines.", ["Git"]),
        ("Containerization", "Create clean dockerized microservices and manage resource limits.", ["Docker"]),
        ("Orchestration & Cloud", "Manage cloud clusters and automated scaling profiles.", ["Kubernetes", "AWS"]),
    ],
    "Cloud Architect": [
        ("Cloud Networking", "Configure virtual private clouds, load balancers, and security layers.", ["AWS"]),
        ("Container Deployment", "Containerize cluster jobs and schedule background services.", ["Docker", "Kubernetes"]),
        ("Scalable Frameworks", "Configure large data frameworks and real-time streams.", ["Hadoop", "PySpark"]),
    ],
    "Data Engineer": [
        ("Database Systems", "Master SQL query patterns and relational tables.", ["SQL"]),
        ("Big Data Pipelines", "Configure PySpark transformations and schema cleansing maps.", ["PySpark", "Hadoop"]),
        ("Orchestration", "Automate data workflows, container schedules, and API triggers.", ["Docker", "AWS"]),
    ],
    "Backend Developer": [
        ("Language Mastery", "Build clean backend routing structures and manage OOP patterns.", ["Python", "JavaScript"]),
        ("API Frameworks", "Expose REST endpoints and configure database ORMs.", ["FastAPI", "SQL"]),
        ("Deploy & Containerize", "Deploy services to production clouds using Docker.", ["Docker", "Git"]),
    ],
}
