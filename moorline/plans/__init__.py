from moorline.plans.landing import land
from moorline.plans.runs import logged_run
from moorline.plans.stages import Stage, StageCounts, load_sql, run_stage, run_stages
from moorline.plans.templates import bind_template
