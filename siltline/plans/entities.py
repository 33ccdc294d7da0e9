"""The eight shipped entities.

The source column names below are fixed values: they must equal the names in the bronze feeds and stand
in target order. Target names follow from the naming rule, except where ``Source(name, target)`` says so.
"""

from siltline.plans.spec import EntitySpec, Null, Source, named, numbered

_DOUBLES = {n: "double" for n in ("ActualMH", "ActualWTV", "BudgetMH", "EVMH", "PlanWTV")}

INSTANCE = Source("Instances_Id", "INSTANCE")
PROJECT = Source("WorkBreakdownUp3Id", "PROJECT")

PROJECTS = EntitySpec(
    name="projects",
    keys=("INSTANCE", "ID"),
    columns=(INSTANCE, *named("Id ProjectIdentifier ProjectName Summary")),
    sequence=(),
    removed_by=None,
)

ASSETS = EntitySpec(
    name="assets",
    keys=("INSTANCE", "ASSET_ID", "WORK_BREAKDOWN_UP3_ID"),
    columns=(
        INSTANCE,
        PROJECT,
        *named(
            """
            Id AssetId AssetTag AssetDescription Service AssetSummary WorkScope TechSpec
            VendorPartNumber ExternalLink DataSourceId Comments Latitude Longitude Altitude ParentID Parent
            InstrumentLineNumID InstrumentLineNum IsDocVerified IsFieldVerified ImageID Image2ID AssetTypeId
            AssetType AssetTypeSummary AssetDisciplineId AssetDiscipline AssetStatusId AssetStatus
            AssetPriorityId AssetPriority
            PhysicalLocationId PhysicalLocationUp1Id PhysicalLocationUp2Id PhysicalLocationUp3Id
            PhysicalLocation
            PhysicalLocationUp1Summary PhysicalLocationUp2Summary PhysicalLocationUp3Summary
            ProcessBreakdownId ProcessBreakdownUp1Id ProcessBreakdownUp2Id ProcessBreakdownUp3Id
            ProcessBreakdown
            ProcessBreakdownUp1Summary ProcessBreakdownUp2Summary ProcessBreakdownUp3Summary
            ControlSystemBreakdownId ControlSystemBreakdownUp1Id ControlSystemBreakdownUp2Id
            ControlSystemBreakdownUp3Id ControlSystemBreakdown
            ControlSystemBreakdownUp1Summary ControlSystemBreakdownUp2Summary
            ControlSystemBreakdownUp3Summary
            ElectricalSourceElectricalRoom ElectricalSourceMCCNumber ElectricalSourceMCCCubical
            SAPFunctionalLocation SAPMaterialCode ListPrice PurchaseOrder PurchaseDate VendorId Vendor
            RecordCreated RecordCreatedBy RecordCreatedById
            RecordLastModified RecordLastModifiedBy RecordLastModifiedById
            dtRemoved RecordRemovedBy RecordRemovedById WorkBreakdownUp3Id CompanyInstanceId
            """,
            {"ListPrice": "decimal(38,12)"},
        ),
    ),
)

WORK_PACKAGES = EntitySpec(
    name="work_packages",
    keys=("INSTANCE", "ID"),
    columns=(
        INSTANCE,
        PROJECT,
        *named(
            f"""
            Id ActualMH ActualStartDate ActualWTV AutoTag BudgetMH ClosingComments Comment
            CompanyInstanceId CurrentWorkflowState CurrentWorkflowStateId Cwp DataSourceId EVMH Ewp
            ExternalLink {numbered("Field{:03d}", 20)}
            JobCategory JobCategoryId JobCategorySummary LaborEqMat PDFImageId Parent ParentId
            PhysicalLocationId PhysicalLocationSummary PhysicalLocationUp1Id PhysicalLocationUp1Summary
            PhysicalLocationUp2Id PhysicalLocationUp2Summary PhysicalLocationUp3Id
            PhysicalLocationUp3Summary PlanWTV
            ProcessBreakdown ProcessBreakdownId ProcessBreakdownUp1Id ProcessBreakdownUp1Summary
            ProcessBreakdownUp2Id ProcessBreakdownUp2Summary ProcessBreakdownUp3Id
            ProcessBreakdownUp3Summary
            ProgressMethod RGBColor RecordCreated RecordCreatedBy RecordCreatedById
            RecordLastModified RecordLastModifiedBy RecordLastModifiedById
            RecordRemovedBy RecordRemovedById ResponsibleCompany ResponsibleCompanyId ScannedImageId
            ScheduleEndDate ScheduleStartDate StatusColor StatusHexColor SupplierCompany SupplierCompanyId
            UsesProcessBreakdown WPDescription WPDiscipline WPDisciplineId WPId WPName WPPriority
            WPPriorityId WPScheduledBy WPScheduledById WPSummary
            WorkBreakdown WorkBreakdownId WorkBreakdownUp1Id WorkBreakdownUp1Summary
            WorkBreakdownUp2Id WorkBreakdownUp2Summary WorkBreakdownUp3Id WorkBreakdownUp3Summary
            WorkPackageClass WorkPackageType WorkPackageTypeId WorkflowId dtRemoved
            """,
            _DOUBLES,
        ),
    ),
)

WORK_PACKAGES_STEPS = EntitySpec(
    name="work_packages_steps",
    keys=("INSTANCE", "WORK_PACKAGES__ID", "ID"),
    columns=(
        INSTANCE,
        PROJECT,
        *named("Id"),
        Source("WorkPackages_Id", "WORK_PACKAGES__ID"),
        *named(
            f"""
            AccessCode ActualMH ActualWTV AssetId AssetPackId AssetPackName AssetTag BudgetMH CanAddStep
            CheckInOutResource CheckInOutResourceId CheckedInDate CheckedOutDate Comments
            CompletedBy CompletedById CompletedDate DocumentId DocumentName EVMH FIWP FWCId FWV
            IWPId IWPName IgnoreStep InspAnswer InspectionType InspectionTypeId IsCheckedOut IsNA
            IsNaDisabled IsStepRequired LoopId LoopName OrderSequence
            {numbered("ParameterReading{}", 15)}
            ParentId PlanEndDate PlanStartDate PlanWTV RecordCreated RecordCreatedBy RecordCreatedById
            RecordLastModified RecordLastModifiedBy RecordLastModifiedById RecordRemovedBy RecordRemovedById
            ShowHeader ShowLabel StepAction StepAnswerId StepAnswerNCId StepHeaders StepParameters
            StepQuestion StepSequence StepSequenceId StepTypeId TaskId TaskName WPId WPName WPStepId
            WPStepName
            """,
            _DOUBLES | {"OrderSequence": "bigint"},
        ),
        Source("WVUoM", "WV_UOM"),
        *named("WorkBreakdownUp3Id WorkStepType WorkStepTypeId WorkVolumeType dtRemoved"),
    ),
)

WORK_PACKAGE_DETAILS = EntitySpec(
    name="work_package_details",
    keys=("INSTANCE", "ID"),
    columns=(
        INSTANCE,
        PROJECT,
        *named(
            f"""
            Id ActualMH ActualStartDate ActualWTV BudgetMH ClosingComments Comment Comments
            CompanyInstanceId CurrentWorkflowState Cwp DataSourceId EVMH Ewp ExchangeName ExternalLink
            {numbered("Field{:03d}", 20)}
            JobCategory JobCategoryId LaborEqMat PDFImageId Parent
            PhysicalLocation PhysicalLocationUp1Summary PhysicalLocationUp2Summary
            PhysicalLocationUp3Summary PlanWTV
            ProcessBreakdown ProcessBreakdownUp1Summary ProcessBreakdownUp2Summary
            ProcessBreakdownUp3Summary
            ProgressMethod RecordCreated RecordCreatedBy RecordLastModified RecordLastModifiedBy
            RecordRemovedBy ResponsibleCompany ResponsibleCompanyId ScannedImageId ScheduleEndDate
            ScheduleStartDate SupplierCompany SupplierCompanyId UsesProcessBreakdown WPDescription
            WPDiscipline WPDisciplineId WPId WPName WPPriority WPPriorityId WPScheduledBy WPSummary
            WorkBreakdown WorkBreakdownUp1Summary WorkBreakdownUp2Summary WorkBreakdownUp3Id
            WorkBreakdownUp3Summary WorkPackageClass WorkPackageType WorkPackageTypeId WorkflowId dtRemoved
            """,
            _DOUBLES,
        ),
    ),
)

WORK_PACKAGE_WORKFLOW_LISTS = EntitySpec(
    name="work_package_workflow_lists",
    keys=("INSTANCE", "WORK_PACKAGE_DETAILS_ID", "ID"),
    columns=(
        INSTANCE,
        Null("PROJECT", "bigint"),
        *named(
            """
            WorkPackageDetails_Id Id WorkflowId StateStatusName StateSequence IsInactive StateComment
            StateRevision StateDate ResourceSummary ResourceStateDate ResourceTypeId ResourceStateSequence
            """
        ),
    ),
    sequence=("StateDate", "ResourceStateDate", "_ingested_at"),
    removed_by=None,
    audit_nulls=(Null("DT_REMOVED", "timestamp"),),
)

TASKS_TESTS_PLANNED_DETAILS = EntitySpec(
    name="tasks_tests_planned_details",
    keys=("INSTANCE", "ID"),
    columns=(
        INSTANCE,
        PROJECT,
        *named(
            f"""
            Id ActualEndDate ActualStartDate ApprovedBy ApprovedDate AssetId AssetPackId AssetPackName
            AssetTag CertLockSyst CertificateCategory CheckInOutResource CheckInOutResourceId CheckedInDate
            CheckedOutDate ClosingComment Comment CompanyInstanceId CompletedBy CompletedByCompany
            CompletedByTitle ContractName EnvironmentalRiskComment ExecutionType ExecutionTypeId
            {numbered("Field{:03d}", 5)}
            HasCancelled HasPermits HasRa InterfaceToolID IsCheckedOut IsException IsLockDates
            IsolationRequired JobId JobName LoopId LoopName Manhours ModelAssetTypeId PartActualEndDate
            PartCompletedBy Persons
            PhysicalLocation PhysicalLocationId PhysicalLocationUp1Id PhysicalLocationUp1Summary
            PhysicalLocationUp2Id PhysicalLocationUp2Summary PhysicalLocationUp3Id
            PhysicalLocationUp3Summary
            ProcessBreakdown ProcessBreakdownId ProcessBreakdownUp1Id ProcessBreakdownUp1Summary
            ProcessBreakdownUp2Id ProcessBreakdownUp2Summary ProcessBreakdownUp3Id
            ProcessBreakdownUp3Summary
            ProjectActivityId ProjectActivityItem ProjectControlTaskId ProjectTaskItem
            RecordCreated RecordCreatedBy RecordLastModified RecordLastModifiedBy RecordRemovedBy
            ResponsibleApprover ResponsibleCompany ResponsibleCompanyId RiskRating SafetyRequirementComment
            ScheduledActualDuration ScheduledDuration ScheduledEndDate ScheduledLagOrLead
            ScheduledStartDate StatusColor StatusHexColor StatusRGBColor SupplierCompany Tag TaskAltitude
            TaskCategory TaskCategoryId TaskCategorySummary TaskDescription TaskDiscipline TaskDisciplineId
            TaskDisciplineSummary TaskDuration TaskDurationEu TaskException TaskId TaskLatitude
            TaskLongitude TaskModelName TaskName TaskPriority TaskPrioritySummary TaskRevision TaskState
            TaskStateId TaskSummary TaskType TaskTypeId TaskTypeSummary
            WorkBreakdown WorkBreakdownId WorkBreakdownUp1Id WorkBreakdownUp1Summary
            WorkBreakdownUp2Id WorkBreakdownUp2Summary WorkBreakdownUp3Id WorkBreakdownUp3Summary
            WorkGroupId WorkGroupName dtRemoved
            """
        ),
    ),
)

TASK_STEP_INSTANCE_DETAILS = EntitySpec(
    name="task_step_instance_details",
    keys=("INSTANCE", "PROJECT", "ID"),
    columns=(
        INSTANCE,
        Source("Projects_Id", "PROJECT"),
        *named(
            f"""
            Id AssetPackName AssetTag Comment CompanyInstanceId CompletedBy CompletedDate DocumentId
            InspAnswer InspectionType IsNa IsNaDisabled IsPunchlist IsStepRequired LoopName OrderSequence
            ParameterReading {numbered("ParameterReading{}", 15)}
            PctWeight PunchlistItem RecordCreated RecordCreatedBy RecordLastModified RecordLastModifiedBy
            RecordRemovedBy StepAction StepAnswer StepAnswerId StepAnswerMap StepIntialsDate StepSequence
            StepType StepTypeId TaskId TaskName TaskStepId WorkBreakdownUp3Id dtRemoved
            """,
            {"OrderSequence": "bigint"},
        ),
    ),
)

ENTITIES = (
    PROJECTS,
    ASSETS,
    WORK_PACKAGES,
    WORK_PACKAGES_STEPS,
    WORK_PACKAGE_DETAILS,
    WORK_PACKAGE_WORKFLOW_LISTS,
    TASKS_TESTS_PLANNED_DETAILS,
    TASK_STEP_INSTANCE_DETAILS,
)
